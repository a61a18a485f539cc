"""A tiny ONNX model (Flatten then Mul by a constant) encoded directly in protobuf wire format.

Only used by the tests: the ``onnx`` package is not available, ONNX Runtime is.
"""

import struct


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _field(num: int, payload) -> bytes:
    if isinstance(payload, int):
        return _varint(num << 3) + _varint(payload)
    if isinstance(payload, str):
        payload = payload.encode()
    return _varint((num << 3) | 2) + _varint(len(payload)) + payload


def _value_info(name: str, dims: list) -> bytes:
    shape = b"".join(_field(1, _field(2, d) if isinstance(d, str) else _field(1, d)) for d in dims)
    tensor_type = _field(1, 1) + _field(2, shape)  # elem_type FLOAT, shape
    return _field(1, name) + _field(2, _field(1, tensor_type))


def scale_model(factor: float) -> bytes:
    """y = flatten(x) * factor for x of shape (n, h, w, c)."""
    const = _field(1, 1) + _field(2, 1) + _field(8, "k") + _field(9, struct.pack("<f", factor))  # dims [1], FLOAT, name, raw
    flatten = _field(1, "x") + _field(2, "flat") + _field(4, "Flatten") + _field(
        5, _field(1, "axis") + _field(3, 1) + _field(20, 2)
    )
    mul = _field(1, "flat") + _field(1, "k") + _field(2, "y") + _field(4, "Mul")
    graph = (
        _field(1, flatten)
        + _field(1, mul)
        + _field(2, "g")
        + _field(5, const)
        + _field(11, _value_info("x", ["n", "h", "w", "c"]))
        + _field(12, _value_info("y", ["n", "m"]))
    )
    return _field(1, 7) + _field(7, graph) + _field(8, _field(2, 13))
