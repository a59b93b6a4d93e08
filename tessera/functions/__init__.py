from tessera.functions.keys import keyed_md5, keyed_hash60, keyed_uniform, keyed_index  # noqa: F401
from tessera.functions.arrays import nan_to_zero, softmax, argmax, pick, axpy  # noqa: F401
