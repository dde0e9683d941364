"""Products of vectors whose numbers are rounded to a byte, by ONNX Runtime where it is installed.

Processors multiply bytes several times as fast as numbers of single precision, which NumPy
does not ask them for. What rounding takes from a vector is measured, so a pair of rounded
vectors tells for certain when the true product is below a bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_LARGEST, _LARGEST_UNSIGNED = 127, 255
#: Whole numbers of the left side are sent as unsigned bytes, above this zero or above none.
_ZERO, _NO_ZERO = np.array(128, np.uint8), np.array(0, np.uint8)
#: Vectors rounded at once, and columns of a product, whose sums stay in the processor's cache.
_ROUNDED_AT_ONCE, _COLUMNS = 1024, 512
#: Sums of more products of two bytes might leave 32 bits.
_MOST_NUMBERS = 1 << 15
# Types of ONNX.
_UNSIGNED, _SIGNED, _WHOLE, _FLAG = 2, 3, 6, 9


@dataclass
class Asked:
    """Unit rows as ``scale`` times bytes above ``zero``; what is missing is no longer than ``lost``."""

    numbers: np.ndarray
    scale: np.ndarray
    lost: np.ndarray
    zero: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Asked:
        if rows.min(initial=0) >= 0:  # as of counted words; no sign has to be kept
            return cls(*_rounded(rows, rows.max(axis=1) / _LARGEST_UNSIGNED, np.uint8), _NO_ZERO)
        numbers, scale, lost = _rounded(rows, _peaks(rows) / _LARGEST, np.int8)
        return cls(numbers.view(np.uint8) ^ _ZERO, scale, lost, _ZERO)

    def take(self, places: np.ndarray) -> Asked:
        return Asked(self.numbers[places], self.scale[places], self.lost[places], self.zero)


@dataclass
class Columns:
    """Unit rows from ``places`` as columns of ``scale`` times bytes; no row lost more than ``lost``."""

    places: np.ndarray
    numbers: np.ndarray
    scale: float
    lost: float


def columns(rows: np.ndarray) -> list[Columns]:
    """Unit rows cut into the columns of a product. A cut has one scale, so its rows have like peaks."""
    peaks, found = _peaks(rows), []
    order = np.argsort(peaks)
    for at in range(0, len(rows), _COLUMNS):
        places = order[at : at + _COLUMNS]
        scale = np.full(len(places), peaks[places[-1]] / _LARGEST)
        numbers, scale, lost = _rounded(rows[places], scale, np.int8)
        found.append(Columns(places, np.ascontiguousarray(numbers.T), scale[0], lost.max()))
    return found


def _peaks(rows: np.ndarray) -> np.ndarray:
    """The largest number of each row, without its sign."""
    return np.maximum(rows.max(axis=1), -rows.min(axis=1))


def _rounded(rows: np.ndarray, scale: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers of each row, its scale and what it lost."""
    numbers, lost = np.empty(rows.shape, kind), np.empty(len(rows))
    for at in range(0, len(rows), _ROUNDED_AT_ONCE):
        cut = slice(at, at + _ROUNDED_AT_ONCE)
        whole = np.rint(rows[cut] / scale[cut, None])
        numbers[cut] = whole
        missing = rows[cut] - whole * scale[cut, None]
        lost[cut] = np.sqrt(np.einsum("ij,ij->i", missing, missing))
    # Rows of single precision are summed up in single precision.
    return numbers, scale.astype(np.float64), lost * 1.001 + 1e-6


def may_reach(asked: Asked, cut: Columns, floor: np.ndarray) -> np.ndarray:
    """Flags of the pairs whose product may be ``floor``, one for each that asks, or more.

    A true product differs from that of the rounded rows by no more than what the left row lost
    and what the right one lost times the length of the rounded left one, which is one at most
    and what it lost.
    """
    bound = floor - asked.lost - (1 + asked.lost) * cut.lost
    bound = np.floor(bound / (asked.scale * cut.scale)).astype(np.int32)[:, None]
    return _session().run(None, {"a": asked.numbers, "b": cut.numbers, "zero": asked.zero, "bound": bound})[0]


def byte_products(dim: int) -> bool:
    """Whether products of rows of ``dim`` bytes can be had here, and are exact."""
    return 0 < dim <= _MOST_NUMBERS and _session() is not None


@lru_cache(maxsize=1)
def _session():
    try:
        import onnxruntime
    except ImportError:
        return None
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1  # a task has one core
    options.log_severity_level = 3
    session = onnxruntime.InferenceSession(_model(), options, providers=["CPUExecutionProvider"])
    return session if _exact(session) else None


def _exact(session) -> bool:
    """Whether the largest numbers are summed up right: older processors stop at 16 bits."""
    signs = np.where(np.arange(64) % 32 < 24, 1, -1)
    right = (np.stack([signs, np.abs(signs), -np.abs(signs)], axis=1) * _LARGEST).astype(np.int8)
    whole = (np.stack([signs, -signs, np.abs(signs)]) * _LARGEST + int(_ZERO)).astype(np.uint8)
    for left, zero in ((whole, _ZERO), (np.full((3, 64), _LARGEST_UNSIGNED, np.uint8), _NO_ZERO)):
        true = ((left.astype(np.int64) - int(zero)) @ right.astype(np.int64)).astype(np.int32)
        for bound in np.concatenate([true.T, true.T + 1]):
            bound = bound[:, None]
            flags = session.run(None, {"a": left, "b": right, "zero": zero, "bound": bound})[0]
            if not np.array_equal(flags, true >= bound):
                return False
    return True


def _model() -> bytes:
    """``a @ b >= bound`` as an ONNX model, where ``a`` is above ``zero``; written as its fields are."""
    nodes = _node("MatMulInteger", ["a", "b", "zero"], "sums") + _node("GreaterOrEqual", ["sums", "bound"], "flags")
    inputs = [("a", _UNSIGNED, 2), ("b", _SIGNED, 2), ("zero", _UNSIGNED, 0), ("bound", _WHOLE, 2)]
    graph = nodes + _field(2, b"graph") + b"".join(_field(11, _tensor(*one)) for one in inputs)
    graph += _field(12, _tensor("flags", _FLAG, 2))
    return _field(1, 8) + _field(7, graph) + _field(8, _field(1, b"") + _field(2, 17))


def _node(kind: str, inputs: list[str], output: str) -> bytes:
    names = b"".join(_field(1, name.encode()) for name in inputs)
    return _field(1, names + _field(2, output.encode()) + _field(4, kind.encode()))


def _tensor(name: str, kind: int, rank: int) -> bytes:
    shape = b"".join(_field(1, _field(2, f"{name}{i}".encode())) for i in range(rank))
    return _field(1, name.encode()) + _field(2, _field(1, _field(1, kind) + _field(2, shape)))


def _field(number: int, value: int | bytes) -> bytes:
    """A field of a protocol buffer."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    return bytes(out + bytes([number]))
