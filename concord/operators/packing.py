"""Row values as a few longs, without loss, so that grouping by whole rows ships fewer bytes.

A row of narrow columns travels as eight bytes and more per column, most of them
empty. One pass over the rows (no shuffle but a row per task) finds the range of every
column; each value then becomes its distance from the least one, in as many bits as the
range needs, and the bits of all columns are laid side by side in longs. Two rows have
equal longs if and only if ``GROUP BY`` sees them as equal:

* integers, booleans, dates, timestamps and decimals to 18 digits are whole numbers of a unit
  (timestamps of days where all are midnights);
* doubles and floats are packed only where every value is ``k / 10^s`` for a whole ``k`` and a fixed ``s`` of 0, 2
  or 4, tested by computing it back; NaN, infinities and finer values fail the test;
* strings only where none is longer than one ASCII character;
* NULL has a code of its own.

A column that does not fit stays as it is beside the longs. A value outside the range found
(a table that changed between the two passes) raises an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.align import quoted

_WORD = 64
_WIDEST = 56  # bits; a column of more gains nothing
_SCALES = (0, 2, 4)  # decimal places of doubles
_LARGEST = 1e11  # a double below has 10^4 parts exactly
_NO_SCALE = 99
_DAY = 86_400_000_000  # microseconds


@dataclass(frozen=True)
class _Code:
    """A whole number (bigint) that stands for a value, and whether it says all about it."""

    value: Column
    whole: Column | None = None  # None: always


def _double_code(x: Column, scale: int) -> _Code:
    parts = F.rint(x * F.lit(10.0**scale))
    return _Code(parts.cast("bigint"), (F.abs(x) < _LARGEST) & (parts / F.lit(10.0**scale) == x))


def _micros(col: Column, dtype: T.DataType) -> Column:
    """Microseconds of a timestamp; of one without time zone by its date and time of day, as no zone may move it."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    second = F.extract(F.lit("SECOND"), col) * F.lit(1_000_000)
    whole = F.hour(col).cast("bigint") * 3600 + F.minute(col).cast("bigint") * 60
    return F.unix_date(col.cast("date")).cast("bigint") * _DAY + whole * 1_000_000 + second.cast("bigint")


def _codes(col: Column, dtype: T.DataType) -> list[_Code]:
    """The codes that may fit a column of this type, the shortest first; none where it is never packed."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [_Code(col.cast("bigint"))]
    if isinstance(dtype, T.BooleanType):
        return [_Code(col.cast("int").cast("bigint"))]
    if isinstance(dtype, T.DateType):
        return [_Code(F.unix_date(col).cast("bigint"))]
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        unit = F.lit(10**dtype.scale).cast(T.DecimalType(dtype.scale + 1, 0))
        return [_Code((col * unit).cast("bigint"))]
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return [_double_code(col.cast("double"), s) for s in _SCALES]
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        micros = _micros(col, dtype)
        days = F.call_function("div", micros, F.lit(_DAY))
        return [_Code(days, days * _DAY == micros), _Code(micros)]
    if dtype == T.StringType():  # other collations have other equalities
        # 0 for the empty string; what is no ASCII character is read as one beyond
        one = F.when(F.octet_length(col) == 0, F.lit(0)).otherwise(F.ascii(col) + 1)
        return [_Code(one.cast("bigint"), (F.octet_length(col) <= 1) & (one <= 128))]
    return []


@dataclass(frozen=True)
class _Fit:
    """How one column is packed: which of its codes, from what least one, in how many bits."""

    name: str
    code: int
    least: int
    most: int
    nulls: bool
    bits: int


def _measured(rows: DataFrame, names: list[str]) -> list[_Fit]:
    """The columns of ``names`` that fit, from one pass over ``rows``."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    wanted, aggs = [], []
    for name in names:
        codes = _codes(quoted(name), types[name])
        if not codes:
            continue
        # the first code of the row that says all about it; the column's is the largest of them
        level = F.lit(_NO_SCALE)
        for k in reversed(range(len(codes))):
            level = F.lit(k) if codes[k].whole is None else F.when(codes[k].whole, F.lit(k)).otherwise(level)
        at = len(wanted)
        wanted.append((name, len(codes)))
        aggs.append(F.max(F.when(quoted(name).isNotNull(), level)).alias(f"l{at}"))
        aggs.append(F.count_if(quoted(name).isNull()).alias(f"z{at}"))
        for k, c in enumerate(codes):
            value = c.value if c.whole is None else F.when(c.whole, c.value)
            aggs += [F.min(value).alias(f"a{at}_{k}"), F.max(value).alias(f"b{at}_{k}")]
    if not wanted:
        return []
    found = rows.agg(*aggs).first()
    fits = []
    for at, (name, n) in enumerate(wanted):
        level, nulls = found[f"l{at}"], found[f"z{at}"] > 0
        if level is None:  # no value at all
            fits.append(_Fit(name, 0, 0, -1, nulls, 0))
        elif level < n:
            least, most = found[f"a{at}_{level}"], found[f"b{at}_{level}"]
            bits = (most - least + nulls).bit_length()
            if bits <= _WIDEST:
                fits.append(_Fit(name, level, least, most, nulls, bits))
    return fits


def _packed_value(fit: _Fit, dtype: T.DataType) -> Column:
    """The value's number from 0, NULL before all others."""
    col = quoted(fit.name)
    code = _codes(col, dtype)[fit.code]
    inside = code.value.between(F.lit(fit.least), F.lit(fit.most)) if fit.least <= fit.most else F.lit(False)
    if code.whole is not None:
        inside = code.whole & inside
    changed = F.raise_error(F.lit(f"column {fit.name} changed while it was read")).cast("bigint")
    number = F.when(inside, code.value - F.lit(fit.least) + F.lit(int(fit.nulls)))
    if fit.nulls:
        return F.when(col.isNull(), F.lit(0).cast("bigint")).otherwise(number.otherwise(changed))
    return number.otherwise(changed)


def _words(fits: list[_Fit]) -> list[list[tuple[_Fit, int]]]:
    """The columns dealt to longs, each with its place in bits: the widest first, into the first with room."""
    words: list[list[tuple[_Fit, int]]] = []
    for fit in sorted(fits, key=lambda f: -f.bits):
        for word in words:
            last, at = word[-1]
            if at + last.bits + fit.bits <= _WORD:
                word.append((fit, at + last.bits))
                break
        else:
            words.append([(fit, 0)])
    return words


def packed_keys(rows: DataFrame, name_lists: list[list[str]], out: str) -> list[dict[str, Column]]:
    """For each list of column names the keys (by name) that stand for them: longs, and the columns that do not fit.

    Runs one pass over ``rows`` when it is called. Names of the longs begin with ``out``.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    fits = {f.name: f for f in _measured(rows, [n for names in name_lists for n in names])}
    keys = []
    for k, names in enumerate(name_lists):
        made = {}
        for j, word in enumerate(_words([fits[n] for n in names if n in fits])):
            whole = F.lit(0).cast("bigint")
            for fit, at in word:
                whole = whole.bitwiseOR(F.shiftleft(_packed_value(fit, types[fit.name]), at))
            made[f"{out}{k}_{j}"] = whole
        keys.append(made | {n: quoted(n) for n in names if n not in fits})
    return keys
