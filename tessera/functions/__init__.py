from tessera.functions.scalar import gelu, gelu_grad, relu, relu_grad

__all__ = ["gelu", "gelu_grad", "relu", "relu_grad"]
