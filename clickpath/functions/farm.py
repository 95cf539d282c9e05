"""FarmHash's public 64-bit fingerprint of text, and the JSON text of a parameter array that it is taken of.

The fingerprint works on whole Arrow batches: each step is a numpy operation over all texts of a kind of length
(up to 16, 32 or 64 bytes, or longer), so no text is looked at on its own. A text of more than 64 bytes takes a
step per 64 bytes, together with all others that are as long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values of the fingerprint
_K0 = np.uint64(0xC3A5C85C97CB3127)
_K1 = np.uint64(0xB492B66FBE98F273)
_K2 = np.uint64(0x9AE16A3B2F90404F)
_SEED = 81

# integers beyond this are quoted, as not every JSON reader keeps them
_EXACT = 2**53


def _u(value: int) -> np.uint64:
    return np.uint64(value % 2**64)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> _u(bits)) | (x << _u(64 - bits))


def _shifted(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> _u(47))


def _joined(x: np.ndarray, y: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return _shifted((y ^ _shifted((x ^ y) * factor)) * factor) * factor


class _Texts:
    """Some texts of a batch: where each starts, its length, and numbers read from it."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.data, self.start, self.size = data, start, size

    def of(self, which: np.ndarray) -> _Texts:
        return _Texts(self.data, self.start[which], self.size[which])

    def byte(self, at: np.ndarray | int) -> np.ndarray:
        return self.data[self.start + at].astype(np.uint64)

    def number(self, at: np.ndarray | int, width: int = 8) -> np.ndarray:
        raw = self.data[(self.start + at)[:, None] + np.arange(width)]
        return np.ascontiguousarray(raw).view(f"<u{width}").ravel().astype(np.uint64)

    @property
    def factor(self) -> np.ndarray:
        return _K2 + self.size.astype(np.uint64) * _u(2)


def _up_to_3(t: _Texts) -> np.ndarray:
    y = t.byte(0) + (t.byte(t.size >> 1) << _u(8))
    z = t.size.astype(np.uint64) + (t.byte(t.size - 1) << _u(2))
    return _shifted(y * _K2 ^ z * _K0) * _K2


def _up_to_7(t: _Texts) -> np.ndarray:
    return _joined(t.size.astype(np.uint64) + (t.number(0, 4) << _u(3)), t.number(t.size - 4, 4), t.factor)


def _up_to_16(t: _Texts) -> np.ndarray:
    first, last = t.number(0) + _K2, t.number(t.size - 8)
    return _joined(_turned(last, 37) * t.factor + first, (_turned(first, 25) + last) * t.factor, t.factor)


def _ends(t: _Texts, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the first and last 16 bytes give, ``first`` being the first eight."""
    second, last, before = t.number(8), t.number(t.size - 8) * t.factor, t.number(t.size - 16) * _K2
    return _turned(first + second, 43) + _turned(last, 30) + before, first + _turned(second + _K2, 18) + last


def _up_to_32(t: _Texts) -> np.ndarray:
    return _joined(*_ends(t, t.number(0) * _K1), t.factor)


def _up_to_64(t: _Texts) -> np.ndarray:
    first = t.number(0) * _K2
    outer, other = _ends(t, first)
    inner = _joined(outer, other, t.factor)
    third, fourth = t.number(16) * t.factor, t.number(24)
    late = (outer + t.number(t.size - 32)) * t.factor
    later = (inner + t.number(t.size - 24)) * t.factor
    return _joined(_turned(third + fourth, 43) + _turned(late, 30) + later, third + _turned(fourth + first, 18) + late, t.factor)


def _of_32(t: _Texts, at: np.ndarray | int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two running numbers carried over the 32 bytes from ``at`` on."""
    first, second, third, fourth = (t.number(at + 8 * i) for i in range(4))
    a = a + first
    b = _turned(b + a + fourth, 21)
    total = a + second + third
    return total + fourth, b + _turned(total, 44) + a


def _block(t: _Texts, at, state: tuple, factor, weight) -> tuple:
    """Seven running numbers carried over the 64 bytes from ``at`` on; ``weight`` is that of the tail, 1 before."""
    x, y, z, v0, v1, w0, w1 = state
    x = _turned(x + y + v0 + t.number(at + 8), 37) * factor
    y = _turned(y + v1 + t.number(at + 48), 42) * factor
    x = x ^ w1 * weight
    y = y + v0 * weight + t.number(at + 40)
    z = _turned(z + w0, 33) * factor
    v0, v1 = _of_32(t, at, v1 * factor, x + w0)
    w0, w1 = _of_32(t, at + 32, z + w1, y + t.number(at + 16))
    return z, y, x, v0, v1, w0, w1


def _longer(t: _Texts) -> np.ndarray:
    # by length, so that the texts that still go on are always the last ones
    order = np.argsort(t.size, kind="stable")
    t = t.of(order)
    n, blocks = len(order), (t.size - 1) // 64
    none = np.zeros(n, dtype=np.uint64)
    y = none + _u(_SEED * int(_K1) + 113)
    state = np.stack([t.number(0) + _u(_SEED * int(_K2)), y, _shifted(y * _K2 + _u(113)) * _K2, none, none, none, none])
    for i in range(int(blocks.max(initial=0))):
        on = slice(int(np.searchsorted(blocks, i, side="right")), n)
        state[:, on] = _block(t.of(on), 64 * i, tuple(state[:, on]), _K1, _u(1))
    x, y, z, v0, v1, w0, w1 = state
    factor = _K1 + ((z & _u(0xFF)) << _u(1))
    w0 = w0 + ((t.size - 1) & 63).astype(np.uint64)
    v0 = v0 + w0
    w0 = w0 + v0
    x, y, z, v0, v1, w0, w1 = _block(t, t.size - 64, (x, y, z, v0, v1, w0, w1), factor, _u(9))
    out = np.empty(n, dtype=np.uint64)
    out[order] = _joined(_joined(v0, w0, factor) + _shifted(y) * _K0 + z, _joined(v1, w1, factor) + x, factor)
    return out


_KINDS = ((0, 3, _up_to_3), (3, 7, _up_to_7), (7, 16, _up_to_16), (16, 32, _up_to_32), (32, 64, _up_to_64), (64, 2**62, _longer))


def fingerprints(texts: pa.Array) -> pa.Array:
    """A signed number for each text; null for null."""
    column = texts.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    every = _Texts(np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets))
    out = np.full(len(column), _K2)
    for above, most, kind in _KINDS:
        which = np.flatnonzero((every.size > above) & (every.size <= most))
        if len(which):
            out[which] = kind(every.of(which))
    return pa.array(out.view(np.int64), mask=np.asarray(column.is_null()))


def farm_fingerprint(text: Column) -> Column:
    return F.arrow_udf(fingerprints, "bigint")(text.cast("string"))


def _quoted(text: Column) -> Column:
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _double_text(x: Column) -> Column:
    """The shortest digits, with an exponent below -4 and from 15 on."""
    plain = F.regexp_replace(x.cast("string"), r"\.0(?=E|$)", "")
    sign = F.when(plain.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.substring_index(plain, "E", 1), "[-.]", "")
    power = F.substring_index(plain, "E", -1).try_cast("int")
    whole = F.rpad(digits, power + 1, "0")
    fixed = F.when(F.length(digits) <= power + 1, whole).otherwise(
        F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    mark = F.concat(F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), "0"))
    return (
        F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.concat(F.lit('"'), x.cast("string"), F.lit('"')))
        .when(x == 0, "0")
        .when(~plain.contains("E"), plain)
        .when(power.between(0, 14), F.concat(sign, fixed))
        .when(power.between(-4, -1), F.concat(sign, small))
        .otherwise(F.concat(F.substring_index(plain, "E", 1), mark))
    )


def _value_text(x: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        parts = []
        for i, field in enumerate(kind.fields):
            parts += [F.lit(("," if i else "{") + f'"{field.name}":'), _value_text(x[field.name], field.dataType)]
        made = F.concat(*parts, F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        made = F.concat(F.lit("["), F.array_join(F.transform(x, lambda e: _value_text(e, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.StringType):
        made = _quoted(x)
    elif isinstance(kind, T.LongType):
        made = F.when(x.between(-_EXACT, _EXACT), x.cast("string")).otherwise(F.concat(F.lit('"'), x.cast("string"), F.lit('"')))
    elif isinstance(kind, T.DoubleType):
        made = _double_text(x)
    else:
        raise ValueError(f"no JSON text for {kind.simpleString()}")
    return F.when(x.isNull(), "null").otherwise(made)


def json_text(value: Column, kind: T.DataType) -> Column:
    """JSON text with every field in order, nulls included and no spaces; integers beyond 2**53 and infinities are quoted."""
    return _value_text(value, kind)
