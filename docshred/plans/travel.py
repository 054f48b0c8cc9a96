"""Columns that only travel through shuffles, in fewer bytes.

A shuffled row takes eight bytes and more for every column, whatever its value.
``small`` puts columns whose values are mostly small into one long, ``texts`` several
texts into one.  Any other value (a null, a broken number, a time of day, a long
text) is carried as it was, so ``unpacked`` gives back every row as it came.
``longs`` and ``joined`` do so in the fewest bytes: what they cannot pack is one column,
``<name>_apart``, that is null in all other rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTER, DIGITS, NUMBER, DAY = "letter", "digits", "number", "day"
# a letter is one byte of UTF-8; a kind that is an int is a whole number of so many bits
BITS = {LETTER: 7, DIGITS: 5, NUMBER: 10, DAY: 16}
LONG_BITS = 63
LENGTH_BITS = 16
BETWEEN = "\0"         # the parts of a ``joined`` text
Kind = str | int


def _code(kind: Kind, value: Column, dtype: str) -> Column:
    """The value as a whole number, null where it is none of its kind."""
    if kind == DAY:
        day = value.cast("date")
        return F.when(day.cast(dtype) == value, F.unix_date(day)).cast("bigint")
    if kind in (DIGITS, NUMBER) or isinstance(kind, int):
        whole = value.try_cast("bigint")
        return F.when(whole.cast(dtype) == value, whole)
    return F.when((F.octet_length(value) == 1) & (F.chr(F.ascii(value)) == value), F.ascii(value)).cast("bigint")


def _value(kind: Kind, code: Column, dtype: str) -> Column:
    if kind == DAY:
        return F.date_from_unix_date(code.cast("int")).cast(dtype)
    return F.chr(code) if kind == LETTER else code.cast(dtype)


def _packed(df: DataFrame, name: str, codes: Sequence[tuple[Column, int]], columns: Sequence[str], *more: Column) -> DataFrame:
    """``name``: the codes side by side, null if one does not fit its bits; the columns
    are kept only where it is null."""
    fits, total, at = F.lit(True), F.lit(0).cast("bigint"), 0
    for code, bits in codes:
        fits, total, at = fits & code.between(0, 2 ** bits - 1), total.bitwiseOR(F.shiftleft(code, at)), at + bits
    assert at < 64, "a long holds 63 bits"
    df = df.select("*", *more).withColumn(name, F.when(fits, total))
    return df.withColumns({c: F.when(F.col(name).isNull(), F.col(c)) for c in columns})


def _bits(name: str, at: int, bits: int) -> Column:
    return F.shiftright(F.col(name), at).bitwiseAND(F.lit(2 ** bits - 1))


def _width(kind: Kind) -> int:
    return kind if isinstance(kind, int) else BITS[kind]


def small(df: DataFrame, name: str, kinds: Mapping[str, Kind]) -> DataFrame:
    """The columns of ``kinds`` as the long ``name``."""
    dtypes = dict(df.dtypes)
    return _packed(df, name, [(_code(k, F.col(c), dtypes[c]), _width(k)) for c, k in kinds.items()], list(kinds))


def _values(name: str, kinds: Mapping[str, Kind], dtypes: Mapping[str, str]) -> dict[str, Column]:
    at, out = 0, {}
    for c, kind in kinds.items():
        out[c], at = _value(kind, _bits(name, at, _width(kind)), dtypes[c]), at + _width(kind)
    return out


def small_unpacked(df: DataFrame, name: str, kinds: Mapping[str, Kind]) -> DataFrame:
    out = _values(name, kinds, dict(df.dtypes))
    return df.withColumns({c: F.when(F.col(name).isNotNull(), v).otherwise(F.col(c)) for c, v in out.items()}).drop(name)


def key_bits(greatest: int | None) -> int:
    """Bits that hold the whole numbers up to ``greatest``."""
    return min(LONG_BITS, max(1, int(greatest or 0).bit_length()))


def in_longs(name: str, kinds: Mapping[str, Kind]) -> dict[str, dict[str, Kind]]:
    """The columns by the long that holds them: each is filled before the next begins."""
    out: dict[str, dict[str, Kind]] = {}
    for c, kind in kinds.items():
        last = out.get(f"{name}_{len(out) - 1}")
        if last is None or sum(map(_width, last.values())) + _width(kind) > LONG_BITS:
            last = out.setdefault(f"{name}_{len(out)}", {})
        last[c] = kind
    return out


def _apart(df: DataFrame, packed: Mapping[str, tuple[Column, Sequence[str]]]) -> DataFrame:
    # generated, so that it is computed once, whatever filters and columns above read it
    df = df.select("*", F.inline(F.array(F.struct(*(value.alias(name) for name, (value, _) in packed.items())))))
    kept = [F.when(F.col(name).isNull(), F.struct(*columns)).alias(f"{name}_apart") for name, (_, columns) in packed.items()]
    return df.select("*", *kept).drop(*(c for _, columns in packed.values() for c in columns))


def longs(df: DataFrame, name: str, kinds: Mapping[str, Kind]) -> DataFrame:
    """The columns of ``kinds`` as the longs ``in_longs``."""
    dtypes, packed = dict(df.dtypes), {}
    for long, held in in_longs(name, kinds).items():
        total, at = F.lit(0).cast("bigint"), 0
        for c, kind in held.items():
            code, bits = _code(kind, F.col(c), dtypes[c]), _width(kind)
            # null if one of them is: it does not fit its bits
            total, at = total.bitwiseOR(F.shiftleft(F.when(code.between(0, 2 ** bits - 1), code), at)), at + bits
        packed[long] = total, list(held)
    return _apart(df, packed)


def longs_columns(df: DataFrame, name: str, kinds: Mapping[str, Kind]) -> dict[str, Column]:
    """The columns as they came."""
    out = {}
    for long, held in in_longs(name, kinds).items():
        apart = df.schema[f"{long}_apart"].dataType
        values = _values(long, held, {c: apart[c].dataType.simpleString() for c in held})
        out |= {c: F.when(F.col(long).isNotNull(), v).otherwise(F.col(f"{long}_apart")[c]) for c, v in values.items()}
    return out


def joined(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """The texts and whole numbers ``columns`` as the text ``name``, null if one is null or
    holds ``BETWEEN``."""
    parts, fits = [F.col(c).cast("string") for c in columns], F.lit(True)
    for text in parts:
        fits = fits & ~F.contains(text, F.lit(BETWEEN))
    return _apart(df, {name: (F.when(fits, F.concat_ws(BETWEEN, *parts)), columns)})


def joined_columns(df: DataFrame, name: str, columns: Sequence[str]) -> dict[str, Column]:
    apart, out = df.schema[f"{name}_apart"].dataType, {}
    for i, c in enumerate(columns):
        text = F.substring_index(F.substring_index(F.col(name), BETWEEN, i + 1), BETWEEN, -1)
        out[c] = F.when(F.col(name).isNotNull(), text.cast(apart[c].dataType)).otherwise(F.col(f"{name}_apart")[c])
    return out


def texts(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """The text columns (three at most) as the bytes ``<name>_bytes`` and the long
    ``name`` of their lengths, one more than that, zero for a null."""
    lengths = [(F.coalesce(F.octet_length(c) + 1, F.lit(0)).cast("bigint"), LENGTH_BITS) for c in columns]
    joined = F.concat(*(F.coalesce(F.col(c).cast("binary"), F.lit(b"")) for c in columns))
    df = _packed(df, name, lengths, columns, joined.alias(f"{name}_bytes"))
    return df.withColumn(f"{name}_bytes", F.when(F.col(name).isNotNull(), F.col(f"{name}_bytes")))


def texts_unpacked(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    out, start = {}, F.lit(1)
    for i, c in enumerate(columns):
        length = _bits(name, i * LENGTH_BITS, LENGTH_BITS).cast("int")
        text = F.substring(F.col(f"{name}_bytes"), start, length - 1).cast("string")
        out[c] = F.when(F.col(name).isNull(), F.col(c)).when(length > 0, text)
        start = start + F.greatest(length - 1, F.lit(0))
    return df.withColumns(out).drop(name, f"{name}_bytes")
