"""DuckDB statements equal to the registered queries (the correctness gate).

Written independently of the Spark code: plain joins, window functions and
aggregates over the pre-registered table views. Values are rounded to 6
digits (``+ 0.0`` turns DuckDB's -0.0 into 0.0, as Spark prints it).
"""

from __future__ import annotations

from tessera.core import hash_uniform_sql as U


def R(x: str) -> str:
    return f"round({x}, 6) + 0.0"


E = """e AS (
  SELECT vec_id, label, j, CAST(v AS DOUBLE) AS v
  FROM (SELECT vec_id, label, unnest(range(len(embedding))) AS j, unnest(embedding) AS v
        FROM embeddings))"""
E2 = "e2 AS (SELECT vec_id, 63 - j AS j, v FROM e)"
W0 = """w0 AS (SELECT k, c, CAST((7 * k + 3 * c) % 11 - 5 AS DOUBLE) / 8.0 AS w
        FROM range(64) a(k), range(10) b(c))"""
NCELLS = "(SELECT count(*) * 64 FROM embeddings)"


def _pair(expr: str) -> str:
    return f"""WITH {E}, {E2}
SELECT a.vec_id, a.j, {R(expr)} AS value FROM e a JOIN e2 b USING (vec_id, j)"""


def _gelu(x: str) -> str:
    return f"0.5 * {x} * (1 + tanh(0.7978845608 * ({x} + 0.044715 * {x} * {x} * {x})))"


def _gelu_grad(x: str, g: str) -> str:
    t = f"tanh(0.7978845608 * ({x} + 0.044715 * {x} * {x} * {x}))"
    return (f"((0.5 * (1 + {t})) + 0.5 * {x} * (1 - {t} * {t}) * "
            f"(0.7978845608 * (1 + 3 * 0.044715 * {x} * {x}))) * {g}")


ATTENTION = f"""WITH
q AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT a.vec_id AS q_id, b.vec_id AS k_id, list_dot_product(a.x, b.x) / sqrt(len(a.x)) AS s
      FROM q a JOIN q b ON a.label = b.label),
p AS (SELECT q_id, k_id, exp(s - max(s) OVER (PARTITION BY q_id)) AS w FROM s),
pn AS (SELECT q_id, k_id, w / sum(w) OVER (PARTITION BY q_id) AS p FROM p),
{E}
SELECT pn.q_id AS vec_id, e.j, {R('sum(pn.p * e.v)')} AS value
FROM pn JOIN e ON pn.k_id = e.vec_id GROUP BY pn.q_id, e.j"""

ATTENTION_VALUES = f"""WITH
q AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT a.vec_id AS q_id, b.vec_id AS k_id, list_dot_product(a.x, b.x) / sqrt(len(a.x)) AS s
      FROM q a JOIN q b ON a.label = b.label),
p AS (SELECT q_id, k_id, exp(s - max(s) OVER (PARTITION BY q_id)) AS w FROM s),
pn AS (SELECT q_id, k_id, w / sum(w) OVER (PARTITION BY q_id) AS p FROM p),
vr AS (SELECT vec_id, j, CAST(v AS DOUBLE) AS v
       FROM (SELECT vec_id, unnest(range(len(embedding))) AS j, unnest(list_reverse(embedding)) AS v
             FROM embeddings))
SELECT pn.q_id AS vec_id, vr.j, {R('sum(pn.p * vr.v)')} AS value
FROM pn JOIN vr ON pn.k_id = vr.vec_id GROUP BY pn.q_id, vr.j"""

LOGITS = f"""{E}, {W0},
z AS (SELECT e.vec_id, w0.c, sum(e.v * w0.w) AS z FROM e JOIN w0 ON e.j = w0.k GROUP BY e.vec_id, w0.c),
zm AS (SELECT vec_id, c, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z),
p AS (SELECT zm.vec_id, zm.c, ez / sum(ez) OVER (PARTITION BY zm.vec_id) AS p, emb.label
      FROM zm JOIN embeddings emb USING (vec_id))"""


def _softmax(coords: str, part: str, source: str) -> str:
    return f"""WITH {E}, src AS ({source}),
m AS (SELECT {coords}, exp(v - max(v) OVER (PARTITION BY {part})) AS ev FROM src)
SELECT {coords}, {R(f'ev / sum(ev) OVER (PARTITION BY {part})')} AS value FROM m"""


W_L1 = f"""w AS (SELECT CAST(id // nk AS INTEGER) AS i, CAST(id % nk AS INTEGER) AS j,
              2 * {U(5, 'id')} - 1 AS w
       FROM dims, range((SELECT nd * nk FROM dims)) t(id))"""
DIMS = """dims AS (SELECT max(len(embedding)) AS nd, count(DISTINCT label) AS nk FROM embeddings)"""
DY = """dy AS (SELECT vec_id, CAST(c AS INTEGER) AS c, CAST(c = label AS DOUBLE) - 0.1 AS dy
        FROM embeddings, range((SELECT nk FROM dims)) t(c))"""

# --- the lineitem network (4 standardised measures -> 16 -> 3) -------------
NET = """st AS (SELECT avg(l_quantity) a0, stddev_pop(l_quantity) s0,
                avg(l_extendedprice) a1, stddev_pop(l_extendedprice) s1,
                avg(l_discount) a2, stddev_pop(l_discount) s2,
                avg(l_tax) a3, stddev_pop(l_tax) s3 FROM lineitem),
li AS (SELECT row_number() OVER () AS r, l_orderkey, l_linenumber,
              (l_quantity - a0) / s0 AS x0, (l_extendedprice - a1) / s1 AS x1,
              (l_discount - a2) / s2 AS x2, (l_tax - a3) / s3 AS x3,
              CASE WHEN l_quantity = 0 THEN -1
                   ELSE CAST(l_extendedprice / l_quantity > 1400 AS INTEGER)
                      + CAST(l_extendedprice / l_quantity > 3100 AS INTEGER) END AS y
       FROM lineitem, st),
xc AS (SELECT r, 0 AS i, x0 AS x FROM li UNION ALL SELECT r, 1, x1 FROM li
       UNION ALL SELECT r, 2, x2 FROM li UNION ALL SELECT r, 3, x3 FROM li),
w1 AS (SELECT i, j, 0.5 * sin(1 + 16 * i + j) AS w FROM range(4) a(i), range(16) b(j)),
b1 AS (SELECT j, 0.1 * cos(1 + j) AS b FROM range(16) t(j)),
w2 AS (SELECT i, j, 0.5 * sin(100 + 3 * i + j) AS w FROM range(16) a(i), range(3) b(j)),
b2 AS (SELECT j, 0.1 * cos(50 + j) AS b FROM range(3) t(j)),
h0 AS (SELECT xc.r, w1.j, sum(xc.x * w1.w) AS s FROM xc JOIN w1 ON xc.i = w1.i GROUP BY xc.r, w1.j),
a AS (SELECT h0.r, h0.j, CASE WHEN s + b < 0 THEN 0.0 ELSE s + b END AS a FROM h0 JOIN b1 USING (j)),
z0 AS (SELECT a.r, w2.j AS k, sum(a.a * w2.w) AS s FROM a JOIN w2 ON a.j = w2.i GROUP BY a.r, w2.j),
z AS (SELECT z0.r, z0.k, s + b AS z FROM z0 JOIN b2 ON z0.k = b2.j),
ez AS (SELECT r, k, exp(z - max(z) OVER (PARTITION BY r)) AS ez FROM z),
p AS (SELECT ez.r, ez.k, ez / sum(ez) OVER (PARTITION BY ez.r) AS p, li.y
      FROM ez JOIN li USING (r)),
n AS (SELECT count(*) AS n FROM li)"""

PRED = """pv AS (SELECT r, max(CASE WHEN k = 0 THEN p END) AS p0, max(CASE WHEN k = 1 THEN p END) AS p1,
               max(CASE WHEN k = 2 THEN p END) AS p2, any_value(y) AS y FROM p GROUP BY r),
pr AS (SELECT *, CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS INTEGER)
                 AS pred FROM pv)"""

GRADS = f"""WITH {NET},
dz AS (SELECT r, k, p - CAST(k = y AS DOUBLE) AS dz FROM p),
loss AS (SELECT sum(CASE WHEN k = y THEN -ln(p + 1e-8) ELSE 0 END) / (SELECT n FROM n) AS loss FROM p),
da AS (SELECT dz.r, w2.i AS j, sum(dz.dz * w2.w) AS da FROM dz JOIN w2 ON dz.k = w2.j GROUP BY dz.r, w2.i),
dh AS (SELECT da.r, da.j, CASE WHEN a.a > 0 THEN da.da ELSE 0.0 END AS dh FROM da JOIN a USING (r, j)),
g AS (
  SELECT 'l1' AS layer, 'W' AS name, xc.i AS i, dh.j AS j, sum(xc.x * dh.dh) AS g
    FROM xc JOIN dh USING (r) GROUP BY xc.i, dh.j
  UNION ALL SELECT 'l1', 'b', 0, j, sum(dh) FROM dh GROUP BY j
  UNION ALL SELECT 'l2', 'W', a.j, dz.k, sum(a.a * dz.dz) FROM a JOIN dz USING (r) GROUP BY a.j, dz.k
  UNION ALL SELECT 'l2', 'b', 0, k, sum(dz) FROM dz GROUP BY k)
SELECT layer, name, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       {R('g / (SELECT n FROM n)')} AS grad, {R('(SELECT loss FROM loss)')} AS loss FROM g"""

PREDICT = f"""WITH {NET}, {PRED}
SELECT li.l_orderkey, li.l_linenumber, pr.pred, {R('pr.p0')} AS p0, {R('pr.p1')} AS p1, {R('pr.p2')} AS p2
FROM pr JOIN li USING (r)"""

EVALUATE = f"""WITH {NET}, {PRED}
SELECT count(*) AS n,
       {R('sum(-ln(CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 END + 1e-8)) / count(*)')} AS loss,
       {R('100.0 * avg(CAST(pred = y AS DOUBLE))')} AS accuracy
FROM pr"""

LINEAR_INIT_ROWS = f"""SELECT 'l1' AS layer, 'W' AS name, i, j, w AS value FROM w
  UNION ALL SELECT 'l1', 'b', 0, CAST(c AS INTEGER), CAST(0 AS DOUBLE) FROM range((SELECT nk FROM dims)) t(c)"""

ATTENTION_CELLS = f"""WITH
q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT a.vec_id AS q_id, b.vec_id AS k_id, list_dot_product(a.x, b.x) / sqrt(len(a.x)) AS s FROM q a, q b),
p AS (SELECT q_id, k_id, exp(s - max(s) OVER (PARTITION BY q_id)) AS w FROM s),
pn AS (SELECT q_id, k_id, w / sum(w) OVER (PARTITION BY q_id) AS p FROM p),
{E}, {E2}
SELECT pn.q_id AS vec_id, e2.j, {R('sum(pn.p * e2.v)')} AS value
FROM pn JOIN e2 ON pn.k_id = e2.vec_id GROUP BY pn.q_id, e2.j"""

UNKNOWN_LABELS = f"""WITH {LOGITS},
u AS (SELECT p.vec_id, c, p, CASE WHEN p.vec_id % 11 = 0 OR label IN (3, 7) THEN -1 ELSE label END AS y FROM p),
mx AS (SELECT *, max(p) OVER (PARTITION BY vec_id) AS m FROM u),
pred AS (SELECT vec_id, min(c) AS k, any_value(y) AS y FROM mx WHERE p = m GROUP BY vec_id),
n AS (SELECT count(*) AS n FROM embeddings)
SELECT 'loss' AS metric, {R('(SELECT sum(CASE WHEN c = y THEN -ln(p + 1e-8) ELSE 0 END) FROM u) / n')} AS value FROM n
UNION ALL SELECT 'accuracy', {R('(SELECT avg(CAST(k = y AS DOUBLE)) * 100.0 FROM pred)')}
UNION ALL SELECT 'targets', {R('(SELECT CAST(count(*) AS DOUBLE) FROM u WHERE c = y)')}
UNION ALL SELECT 'grad', {R('(SELECT sum(abs(p - CAST(c = y AS DOUBLE))) FROM u) / n')} FROM n"""

# every 5th order's line is broken in one of five ways
BROKEN = """b AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, l_orderkey % 25 AS k, l_quantity,
  l_returnflag FROM lineitem)"""


def wide_sql(hidden: int = 16_384, inputs: int = 64) -> str:
    """One full-batch Adam step of the wide network: rows and weights as lists, products as their dot products."""
    def step(w, g):
        # the first step: both moments' corrections cancel
        return f"{w} - 0.01 * ({g}) / (abs({g}) + 1e-8)"

    classes = "(SELECT count(DISTINCT label) FROM embeddings)"
    return f"""WITH
x AS (SELECT vec_id, list_append(CAST(embedding AS DOUBLE[]), 1.0) AS x, label AS y FROM embeddings),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM x),
c1 AS (SELECT id // {hidden} AS i, id % {hidden} AS u, (2.0 * {U(5, 'id')} - 1.0) / 64.0 AS w
       FROM range({inputs * hidden}) r(id)),
w1 AS (SELECT u, list_append(list(w ORDER BY i), 0.0) AS w FROM c1 GROUP BY u),
c2 AS (SELECT id // k AS u, id % k AS c, (2.0 * {U(6, 'id')} - 1.0) / 64.0 AS w
       FROM (SELECT {classes} AS k), range({hidden} * {classes}) r(id)),
w2 AS (SELECT c, list_append(list(w ORDER BY u), 0.0) AS w FROM c2 GROUP BY c),
a AS (SELECT vec_id, u, greatest(list_dot_product(x.x, w1.w), 0.0) AS a FROM x, w1),
rows AS (SELECT vec_id, list_append(list(a ORDER BY u), 1.0) AS a FROM a GROUP BY vec_id),
z AS (SELECT vec_id, c, list_dot_product(rows.a, w2.w) AS z FROM rows, w2),
e AS (SELECT vec_id, c, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z),
dz AS (SELECT vec_id, c, e / sum(e) OVER (PARTITION BY vec_id) - CASE WHEN c = y THEN 1 ELSE 0 END AS d
       FROM e JOIN x USING (vec_id)),
dzc AS (SELECT c, list(d ORDER BY vec_id) AS d FROM dz GROUP BY c),
dzr AS (SELECT vec_id, list(d ORDER BY c) AS d FROM dz GROUP BY vec_id),
ac AS (SELECT u, list(a ORDER BY vec_id) AS a FROM a GROUP BY u
       UNION ALL SELECT {hidden}, list(1.0::DOUBLE ORDER BY vec_id) FROM x),
g2 AS (SELECT u, c, list_dot_product(ac.a, dzc.d) / n AS g FROM ac, dzc, n),
w2r AS (SELECT u, list(w ORDER BY c) AS w FROM c2 GROUP BY u),
dh AS (SELECT a.vec_id, a.u, CASE WHEN a.a > 0 THEN list_dot_product(dzr.d, w2r.w) ELSE 0.0 END AS d
       FROM a JOIN dzr USING (vec_id) JOIN w2r USING (u)),
dhc AS (SELECT u, list(d ORDER BY vec_id) AS d FROM dh GROUP BY u),
xc AS (SELECT i, list(v ORDER BY vec_id) AS v
       FROM (SELECT vec_id, unnest(range(len(x))) AS i, unnest(x) AS v FROM x) GROUP BY i),
g1 AS (SELECT u, i, list_dot_product(xc.v, dhc.d) / n AS g FROM xc, dhc, n),
new1 AS (SELECT u, list({R(step('coalesce(w, 0.0)', 'g'))} ORDER BY i) AS w_in FROM g1 LEFT JOIN c1 USING (u, i) GROUP BY u),
new2 AS (SELECT u, list({R(step('coalesce(w, 0.0)', 'g'))} ORDER BY c) AS w_out FROM g2 LEFT JOIN c2 USING (u, c) GROUP BY u)
SELECT CAST(new2.u AS BIGINT) AS unit, coalesce(w_in, CAST([] AS DOUBLE[])) AS w_in, w_out FROM new2 LEFT JOIN new1 USING (u)"""


def train_sql(epochs: int = 3, hidden: int = 16, classes: int = 3, seed: int = 7, share: float = 0.8) -> str:
    """Full-batch training without dropout, unrolled: one row of parameters per epoch."""
    net = NET[:NET.index("xc AS")]
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    net = net.replace("l_orderkey, l_linenumber,", "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,")
    params = [(f"w1_{i}_{u}", ("l1", i * hidden + u)) for i in range(4) for u in range(hidden)]
    params += [(f"b1_{u}", None) for u in range(hidden)]
    params += [(f"w2_{u}_{c}", ("l2", u * classes + c)) for u in range(hidden) for c in range(classes)]
    params += [(f"b2_{c}", None) for c in range(classes)]
    names = [p for p, _ in params]
    order = ", ".join([U(seed, *keys[:-1], "CAST(l_quantity AS VARCHAR)"), *keys])

    def start(spec):
        return "CAST(0 AS DOUBLE)" if spec is None else f"2 * {U(seed + (spec[0] == 'l2'), str(spec[1]))} - 1"

    steps = [net.rstrip().rstrip(","),
             f"ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rn, count(*) OVER () AS n FROM li)",
             f"d AS (SELECT r, x0, x1, x2, x3, y, rn <= floor({share} * n) AS tr FROM ranked)",
             "p0 AS (SELECT " + ", ".join(f"{start(spec)} AS {p}, CAST(0 AS DOUBLE) AS m_{p}, CAST(0 AS DOUBLE) AS v_{p}"
                                          for p, spec in params) + ")"]

    def forward(e):
        acts = ", ".join(f"greatest(0, b1_{u} + " + " + ".join(f"x{i} * w1_{i}_{u}" for i in range(4)) + f") AS h{u}"
                         for u in range(hidden))
        z = ", ".join(f"b2_{c} + " + " + ".join(f"h{u} * w2_{u}_{c}" for u in range(hidden)) + f" AS z{c}" for c in range(classes))
        top = f"greatest({', '.join(f'z{c}' for c in range(classes))})"
        keep = ", ".join(f"w2_{u}_{c}" for u in range(hidden) for c in range(classes))
        hs = ", ".join(f"h{u}" for u in range(hidden))
        w2b = ", ".join(f"b2_{c}" for c in range(classes))
        return [f"a{e} AS (SELECT d.*, {acts}, {keep}, {w2b} FROM d, p{e})",
                f"z{e} AS (SELECT r, tr, y, x0, x1, x2, x3, {hs}, {keep}, {z} FROM a{e})",
                f"e{e} AS (SELECT *, {', '.join(f'exp(z{c} - {top}) AS e{c}' for c in range(classes))} FROM z{e})",
                f"q{e} AS MATERIALIZED (SELECT *, {', '.join(f'e{c} / ({" + ".join(f"e{k}" for k in range(classes))}) AS p{c}' for c in range(classes))} FROM e{e})"]

    def losses(e, which):
        picked = "CASE y " + " ".join(f"WHEN {c} THEN p{c}" for c in range(classes)) + " END"
        return f"(SELECT sum(CASE WHEN y >= 0 THEN -ln({picked} + 1e-8) ELSE 0 END) / count(*) FROM q{e} WHERE {which})"

    out = []
    for e in range(epochs + 1):
        steps += forward(e)
        if e:
            best = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"
            out.append(f"SELECT CAST({e} AS INTEGER) AS epoch, round({losses(e - 1, 'tr')}, 5) AS train_loss, "
                       f"round({losses(e, 'NOT tr')}, 5) AS val_loss, "
                       f"round((SELECT 100.0 * avg(CAST({best} = y AS DOUBLE)) FROM q{e} WHERE NOT tr), 5) AS val_acc")
        if e == epochs:
            break
        dz = ", ".join(f"p{c} - CAST(y = {c} AS DOUBLE) AS d{c}" for c in range(classes))
        steps.append(f"g{e} AS (SELECT *, {dz} FROM q{e} WHERE tr)")
        back = ", ".join(f"CASE WHEN h{u} > 0 THEN " + " + ".join(f"d{c} * w2_{u}_{c}" for c in range(classes)) + f" ELSE 0 END AS k{u}"
                         for u in range(hidden))
        steps.append(f"k{e} AS (SELECT *, {back} FROM g{e})")
        grads = [f"sum(x{i} * k{u}) / count(*) AS g_w1_{i}_{u}" for i in range(4) for u in range(hidden)]
        grads += [f"sum(k{u}) / count(*) AS g_b1_{u}" for u in range(hidden)]
        grads += [f"sum(h{u} * d{c}) / count(*) AS g_w2_{u}_{c}" for u in range(hidden) for c in range(classes)]
        grads += [f"sum(d{c}) / count(*) AS g_b2_{c}" for c in range(classes)]
        steps.append(f"s{e} AS MATERIALIZED (SELECT {', '.join(grads)} FROM k{e})")
        moments = ", ".join(f"{p}, 0.9 * m_{p} + (1 - 0.9) * g_{p} AS m_{p}, 0.999 * v_{p} + (1 - 0.999) * g_{p} * g_{p} AS v_{p}"
                            for p in names)
        steps.append(f"o{e} AS (SELECT {moments} FROM p{e}, s{e})")
        t = e + 1
        update = ", ".join(f"{p} - 0.01 * (m_{p} / (1 - pow(0.9, {t}))) / (sqrt(v_{p} / (1 - pow(0.999, {t}))) + 1e-8) AS {p}, m_{p}, v_{p}"
                           for p in names)
        steps.append(f"p{t} AS MATERIALIZED (SELECT {update} FROM o{e})")
    return "WITH " + ",\n".join(steps) + "\n" + "\nUNION ALL ".join(out)


ORACLE: dict[str, str] = {
    "attention_by_label": ATTENTION,
    "attention_by_label_tiled": ATTENTION,
    "attention_by_label_values": ATTENTION_VALUES,
    "attention_cells": ATTENTION_CELLS,
    "unknown_labels": UNKNOWN_LABELS,
    "read_labeled_csv_rejects": f"""WITH {BROKEN} SELECT id, CASE k WHEN 0 THEN 'empty field' WHEN 15 THEN 'missing label'
  WHEN 20 THEN 'too many fields' ELSE 'bad number' END AS reason FROM b WHERE k IN (0, 5, 10, 15, 20)""",
    "read_labeled_csv_zero": f"""WITH {BROKEN} SELECT id, {R("CASE k WHEN 5 THEN 12.0 WHEN 10 THEN 0.0 ELSE l_quantity END")} AS f0,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END AS INTEGER) AS label
  FROM b WHERE k NOT IN (0, 15, 20) AND l_returnflag IN ('A', 'N')""",
    "read_labeled_csv_head": f"""WITH {BROKEN} SELECT least(1000, count(*)) AS n
  FROM b WHERE k NOT IN (0, 5, 10, 15, 20)""",
    "mlp_train_plain": train_sql(),
    "rows_to_cells": f"WITH {E} SELECT vec_id, j, {R('v')} AS value FROM e",
    "cells_to_rows": """SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x, 6) + 0.0)
       AS features FROM embeddings""",
    "fill_ones": f"SELECT i // 64 AS c0, i % 64 AS c1, CAST(1 AS DOUBLE) AS value FROM range({NCELLS}) t(i)",
    "fill_zeros": f"SELECT i // 64 AS c0, i % 64 AS c1, CAST(0 AS DOUBLE) AS value FROM range({NCELLS}) t(i)",
    "fill_uniform": f"SELECT i // 64 AS c0, i % 64 AS c1, {R('2 * ' + U(7, 'i') + ' - 1')} AS value "
                    f"FROM range({NCELLS}) t(i)",
    "scale": f"WITH {E} SELECT vec_id, j, {R('v * 0.5')} AS value FROM e",
    "relu": f"WITH {E} SELECT vec_id, j, {R('CASE WHEN v < 0 THEN 0.0 ELSE v END')} AS value FROM e",
    "gelu": f"WITH {E} SELECT vec_id, j, {R(_gelu('(4.0 * v)'))} AS value FROM e",
    "transpose": f"WITH {E} SELECT j AS c0, vec_id AS c1, {R('v')} AS value FROM e",
    "reshape": f"WITH {E} SELECT vec_id AS c0, j // 8 AS c1, j % 8 AS c2, {R('v')} AS value FROM e",
    "cell_at": f"WITH {E} SELECT vec_id, j, {R('v')} AS value FROM e WHERE j = label",
    "shape_of": f"""WITH {E}
SELECT 2 AS rank, max(vec_id) + 1 AS d0, max(j) + 1 AS d1, count(*) AS n_cells,
       count(DISTINCT (vec_id, j)) AS n_distinct,
       (count(*) = (max(vec_id) + 1) * (max(j) + 1) AND count(DISTINCT (vec_id, j)) = count(*)
        AND count(v) = count(*)) AS dense
FROM e""",
    "one_hot": f"""SELECT vec_id, k, {R('CAST(label = k AS DOUBLE)')} AS value
FROM embeddings, range(10) t(k)""",
    "dropout": f"""WITH {E} SELECT vec_id, j,
  {R('CASE WHEN ' + U(11, 'vec_id', 'j') + ' < 0.1 THEN 0.0 ELSE v / (1 - 0.1) END')} AS value FROM e""",
    "add": _pair("a.v + b.v"),
    "add_sparse": _pair("(CASE WHEN a.v > 0 THEN a.v ELSE 0.0 END) + (CASE WHEN b.v > 0 THEN b.v ELSE 0.0 END)"),
    "one_hot_sparse": "SELECT vec_id, label AS k, CAST(1 AS DOUBLE) AS value FROM embeddings WHERE label BETWEEN 0 AND 9",
    "matmul_sparse": f"""WITH {E}
SELECT label, j, {R('sum(v)')} AS value FROM e WHERE label BETWEEN 0 AND 9 GROUP BY label, j""",
    "sub": _pair("a.v - b.v"),
    "mul": _pair("a.v * b.v"),
    "relu_backward": _pair("CASE WHEN a.v > 0 AND NOT isnan(a.v) THEN b.v ELSE 0.0 END"),
    "gelu_backward": _pair(_gelu_grad("(4.0 * a.v)", "b.v")),
    "add_bias": f"WITH {E} SELECT vec_id, j, {R('v + (j - 32) / 64.0')} AS value FROM e",
    "matmul": f"""WITH {E}, {W0}
SELECT e.vec_id, w0.c, {R('sum(e.v * w0.w)')} AS value FROM e JOIN w0 ON e.j = w0.k GROUP BY e.vec_id, w0.c""",
    "matmul_acc": f"""WITH {E}, {W0}
SELECT e.vec_id, w0.c, {R('sum(e.v * w0.w) + 1.0')} AS value FROM e JOIN w0 ON e.j = w0.k
GROUP BY e.vec_id, w0.c""",
    "matmul_block": f"""WITH {E}, {W0}
SELECT e.vec_id, w0.c, {R('sum(e.v * w0.w)')} AS value FROM e JOIN w0 ON e.j = w0.k GROUP BY e.vec_id, w0.c""",
    "gram": f"""WITH {E}
SELECT a.j AS c0, b.j AS c1, {R('sum(a.v * b.v)')} AS value FROM e a JOIN e b USING (vec_id) GROUP BY a.j, b.j""",
    "gram_block": f"""WITH {E}
SELECT a.j AS c0, b.j AS c1, {R('sum(a.v * b.v)')} AS value FROM e a JOIN e b USING (vec_id) GROUP BY a.j, b.j""",
    "col_sum": f"WITH {E} SELECT j, {R('sum(v)')} AS value FROM e GROUP BY j",
    "softmax_rows": _softmax("vec_id, j", "vec_id", "SELECT vec_id, j, v FROM e"),
    "softmax_axis0": _softmax("vec_id, j", "j", "SELECT vec_id, j, v FROM e"),
    "softmax_axis0_grouped": _softmax("vec_id, j", "j", "SELECT vec_id, j, v FROM e"),
    "softmax_3d": _softmax("c0, c1, c2", "c0, c2",
                           "SELECT vec_id AS c0, j // 8 AS c1, j % 8 AS c2, v FROM e"),
    "argmax_rows": f"""WITH {E}, m AS (SELECT vec_id, j, v, max(v) OVER (PARTITION BY vec_id) AS mx FROM e)
SELECT vec_id, min(j) AS k FROM m WHERE v = mx GROUP BY vec_id""",
    "cross_entropy": f"""WITH {LOGITS}
SELECT {R('sum(CASE WHEN c = label THEN -ln(p + 1e-8) ELSE 0 END) / (SELECT count(*) FROM embeddings)')} AS loss
FROM p""",
    "accuracy": f"""WITH {LOGITS},
mx AS (SELECT vec_id, c, p, label, max(p) OVER (PARTITION BY vec_id) AS m FROM p),
pred AS (SELECT vec_id, min(c) AS k, any_value(label) AS label FROM mx WHERE p = m GROUP BY vec_id)
SELECT {R('avg(CAST(k = label AS DOUBLE)) * 100.0')} AS accuracy FROM pred""",
    "softmax_xent_grad": f"""WITH {LOGITS}
SELECT vec_id, c AS k, {R('(p - CAST(c = label AS DOUBLE)) / (SELECT count(*) FROM embeddings)')} AS value FROM p""",
    "shuffle_rank": f"""SELECT o_orderkey, row_number() OVER (ORDER BY {U(7, 'o_orderkey')}, o_orderkey) AS rank
FROM orders""",
    "train_val_split": f"""SELECT o_orderkey,
  row_number() OVER (ORDER BY {U(7, 'o_orderkey')}, o_orderkey) <= floor(0.8 * (SELECT count(*) FROM orders))
  AS is_train FROM orders""",
    "encode_labels": """SELECT l_orderkey, l_linenumber, l_returnflag,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END AS INTEGER) AS label FROM lineitem""",
    "read_labeled_csv": f"""SELECT CAST(l_orderkey AS VARCHAR) AS id, {R('l_quantity')} AS f0,
  {R('l_extendedprice')} AS f1, {R('l_discount')} AS f2, {R('l_tax')} AS f3, l_returnflag AS label_name,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END AS INTEGER) AS label FROM lineitem""",
    "mlp_train_wide": wide_sql(),
    "linear_init": f"""WITH {DIMS}, {W_L1}, rows AS ({LINEAR_INIT_ROWS})
SELECT layer, name, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {R('value')} AS value,
  CAST(0 AS DOUBLE) AS grad, CAST(0 AS DOUBLE) AS m, CAST(0 AS DOUBLE) AS v FROM rows""",
    "linear_forward": f"""WITH {DIMS}, {W_L1}, {E}
SELECT e.vec_id, CAST(w.j AS BIGINT) AS j, {R('sum(e.v * w.w)')} AS value
FROM e JOIN w ON e.j = w.i GROUP BY e.vec_id, w.j""",
    "linear_dw": f"""WITH {DIMS}, {DY}, {E}
SELECT CAST(e.j AS INTEGER) AS i, dy.c AS j, {R('sum(e.v * dy.dy)')} AS grad
FROM e JOIN dy USING (vec_id) GROUP BY e.j, dy.c""",
    "linear_db": f"""WITH {DIMS}, {DY}
SELECT c AS j, {R('sum(dy)')} AS grad FROM dy GROUP BY c""",
    "linear_dx": f"""WITH {DIMS}, {W_L1}, {DY}
SELECT dy.vec_id, CAST(w.i AS BIGINT) AS j, {R('sum(dy.dy * w.w)')} AS value
FROM dy JOIN w ON dy.c = w.j GROUP BY dy.vec_id, w.i""",
    "adam_step": f"""WITH {DIMS}, {W_L1}, {DY}, {E},
g AS (SELECT CAST(e.j AS INTEGER) AS i, dy.c AS j, 'W' AS name, sum(e.v * dy.dy) AS g
      FROM e JOIN dy USING (vec_id) GROUP BY e.j, dy.c
      UNION ALL SELECT 0, c, 'b', sum(dy) FROM dy GROUP BY c),
p AS (SELECT 'W' AS name, i, j, w AS value FROM w
      UNION ALL SELECT 'b', 0, CAST(c AS INTEGER), CAST(0 AS DOUBLE) FROM range((SELECT nk FROM dims)) t(c)),
s AS (SELECT p.name, p.i, p.j, p.value, g.g, 0.1 * g.g AS m, (1 - 0.999) * g.g * g.g AS v
      FROM p JOIN g USING (name, i, j))
SELECT 'l1' AS layer, name, i, j,
  {R('value - 0.01 * (m / (1 - 0.9)) / (sqrt(v / (1 - 0.999)) + 1e-8)')} AS value,
  {R('g')} AS grad, {R('m')} AS m, {R('v')} AS v FROM s""",
    "mlp_gradients": GRADS,
    "mlp_predict": PREDICT,
    "mlp_predict_stream": PREDICT,
    "mlp_evaluate": EVALUATE,
}
for _name, _same in (("add_tables", "add"), ("add_bucketed", "add"),
                     ("read_labeled_csv_stream", "read_labeled_csv_zero"),
                     ("read_labeled_csv_stream_rejects", "read_labeled_csv_rejects"),
                     ("softmax_rows_packed", "softmax_rows"), ("argmax_rows_packed", "argmax_rows"),
                     ("cross_entropy_cells", "cross_entropy"), ("accuracy_cells", "accuracy"),
                     ("softmax_xent_grad_cells", "softmax_xent_grad")):
    ORACLE[_name] = ORACLE[_same]
