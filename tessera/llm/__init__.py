"""Training-data operators: ten corpus operators, each as a Spark job.

Nothing outside this subpackage imports it. ``queries.py`` registers the
operators over the driver's tables; ``corpus_pipeline.py`` at the repository
top chains five of them.
"""
