"""Decoding of row images: packed bytes to text cells, text cells to typed values. All built-in expressions, so filters above prune."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import ColumnType

UINT64_SPAN = 18446744073709551616  # 2**64


@dataclass(frozen=True)
class DecodeOptions:
    """How values are written; the defaults are those of the configuration."""

    uint64: str = "string"  # string, precise or long
    binary: str = "bytes"  # bytes, base64 or hex
    time_precision: str = "adaptive_time_microseconds"  # or connect, isostring
    override_datetime_to_nullable: bool = False
    include_unknown: bool = False
    precise_decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    converters: dict[str, Callable[[Column, ColumnType], Column | None]] = field(default_factory=dict)


def unpack(row: Column) -> Column:
    """Cells of a packed row: array<binary>, null where the length is negative. Lengths that don't add up to the bytes are an error."""
    lengths, values = row["lengths"], row["values"]
    real = F.transform(lengths, lambda n: F.greatest(n, F.lit(0).cast("bigint")))
    # Start of each cell: running sum, carried with the cells in one fold.
    start = F.struct(F.lit(1).cast("bigint").alias("at"), F.array().cast("array<binary>").alias("cells"))
    cell = lambda acc, n: F.when(n < 0, F.lit(None).cast("binary")).otherwise(F.substring(values, acc["at"].cast("int"), n.cast("int")))
    folded = F.aggregate(lengths, start, lambda acc, n: F.struct((acc["at"] + F.greatest(n, F.lit(0).cast("bigint"))).alias("at"), F.concat(acc["cells"], F.array(cell(acc, n))).alias("cells")), lambda acc: acc["cells"])
    total = F.aggregate(real, F.lit(0).cast("bigint"), lambda a, n: a + n)
    return F.when(row.isNull(), F.lit(None)).when(total == F.coalesce(F.length(values), F.lit(0)), folded).otherwise(F.raise_error(F.lit("lengths of a row do not add up to its bytes")).cast("array<binary>"))


def cells(row: Column, n: int) -> list[Column]:
    """The n cells of a packed row, by plain expressions that compile; another number of lengths, or lengths that don't add up to the
    bytes, are errors."""
    size = lambda i: F.greatest(row["lengths"][i], F.lit(0).cast("bigint")).cast("int")
    starts = [F.lit(1)]
    for i in range(n):
        starts.append(starts[-1] + size(i))
    bad = F.when(F.size(row["lengths"]) != n, F.lit("row and schema differ in their number of columns")).when(starts[-1] - 1 != F.coalesce(F.length(row["values"]), F.lit(0)), F.lit("lengths of a row do not add up to its bytes"))
    values = F.when(row.isNotNull() & bad.isNotNull(), F.raise_error(bad).cast("binary")).otherwise(row["values"])
    return [F.when(row["lengths"][i] >= 0, F.substring(values, starts[i], size(i))) for i in range(n)]


def text(cell: Column) -> Column:
    return cell.cast("string")


def enum_label(index: Column, options: tuple[str, ...]) -> Column:
    """Label of a 1-based index; what is out of range, 0 included, is the empty label."""
    labels = F.array(*(F.lit(o) for o in options)) if options else F.array().cast("array<string>")
    return F.when(index.isNotNull(), F.coalesce(F.get(labels, index.cast("int") - 1), F.lit("")))


def enum_value(raw: Column, options: tuple[str, ...]) -> Column:
    """An index as text becomes its label; other text is a label already."""
    return F.when(raw.rlike(r"^[0-9]+$"), enum_label(raw.try_cast("bigint"), options)).otherwise(raw)


def set_labels(mask: Column, options: tuple[str, ...]) -> Column:
    """Comma-joined labels of the bits set, lowest first; a bit without a label leaves its comma. One plain expression per label; only
    masks with bits beyond the labels take the general way."""
    labels = [F.when(mask.bitwiseAND(F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint")) != 0, F.lit(o)) for i, o in enumerate(options[:64])]
    known = sum(1 << i for i in range(min(len(options), 64)))
    known = known - (1 << 64) if known >= 1 << 63 else known
    extra = F.bit_count(mask.bitwiseAND(F.lit(~known).cast("bigint")))
    named = F.concat_ws(",", *labels) if labels else F.lit("")
    some = mask.bitwiseAND(F.lit(known).cast("bigint")) != 0
    return F.when(mask.isNotNull(), F.when(extra == 0, named).otherwise(F.concat(named, F.repeat(F.lit(","), F.when(some, extra).otherwise(extra - 1)))))


def uint64(raw: Column, mode: str) -> Column:
    """Unsigned 64-bit text as text, exact decimal or (wrapped) long. Negative numbers stand for themselves plus 2**64."""
    if mode == "string":
        return raw
    n = raw.cast("decimal(20,0)")
    whole = F.when(n < 0, n + F.lit(str(UINT64_SPAN)).cast("decimal(20,0)")).otherwise(n).cast("decimal(20,0)")
    if mode == "precise":
        return whole
    if mode == "long":
        return F.when(n > F.lit(str(2**63 - 1)).cast("decimal(20,0)"), n - F.lit(str(UINT64_SPAN)).cast("decimal(20,0)")).otherwise(n).cast("bigint")
    raise ValueError(f"unknown mode for unsigned 64-bit numbers: {mode}")


def time_micros(raw: Column) -> Column:
    """[-]h+:mm[:ss[.fraction]] as microseconds; any number of hours, the sign holds for all parts."""
    pattern = r"^(-?)(\d+):(\d+)(?::(\d+))?(?:\.(\d+))?$"
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(raw, pattern, k), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))
    nanos = F.rpad(F.regexp_extract(raw, pattern, 5), 9, "0").cast("bigint")
    size = (part(2) * 3600 + part(3) * 60 + part(4)) * 1_000_000 + F.floor(nanos / 1000)
    ok = raw.rlike(pattern)
    return F.when(raw.isNull(), None).when(ok, F.when(raw.startswith("-"), -size).otherwise(size)).otherwise(F.raise_error(F.concat(F.lit("not a time: "), raw)).cast("bigint"))


def date_value(raw: Column) -> Column:
    """Null where month or day is zero; year 0 is a year."""
    return F.when(raw.rlike(r"^\d+-(00-\d\d|\d\d-00)$"), None).otherwise(raw.cast("date"))


def _zero_date_time(raw: Column) -> Column:
    return raw.rlike(r"^\d{4}-00-00")


def datetime_value(raw: Column) -> Column:
    """timestamp_ntz; null for a zero date, an error for other text that is none."""
    return F.when(_zero_date_time(raw), None).otherwise(raw.cast("timestamp_ntz"))


def datetime_number(value: Column, scale: int, mode: str) -> Column:
    """Milliseconds up to three fraction digits (always, in connect mode), microseconds above."""
    micros = F.unix_micros(value.cast("timestamp"))
    return F.floor(micros / 1000).cast("bigint") if mode == "connect" or scale <= 3 else micros


def timestamp_value(raw: Column) -> Column:
    """timestamp in UTC (the session's zone must be UTC); null for a zero date or text that is none."""
    return F.when(_zero_date_time(raw), None).otherwise(raw.try_cast("timestamp"))


def iso_timestamp(value: Column, scale: int) -> Column:
    fraction = "." + "S" * scale if scale else ""
    return F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss{fraction}'Z'")


def bit_value(raw: Column, length: int | None) -> Column:
    """BIT(1) is whether its first byte is not 0 (empty: no); longer ones are their bytes."""
    if length == 1:
        return F.when(raw.isNotNull(), (F.length(raw) > 0) & (F.substring(raw, 1, 1) != F.lit(b"\x00")))
    return raw


def binary_value(raw: Column, mode: str) -> Column:
    if mode == "bytes":
        return raw
    if mode == "hex":
        return F.lower(F.hex(raw))
    if mode == "base64":
        return F.regexp_replace(F.base64(raw), r"[\r\n]", "")
    raise ValueError(f"unknown mode for binary values: {mode}")


def value(cell: Column, kind: ColumnType, options: DecodeOptions | None = None, declared: str = "") -> Column | None:
    """Typed value of a raw cell (binary); None where the column is left out. Nulls of NOT NULL date columns become the epoch."""
    o = options or DecodeOptions()
    for name, convert in o.converters.items():
        if name == declared and (found := convert(cell, kind)) is not None:
            return found
    s, k, connect, iso = text(cell), kind.kind, o.time_precision == "connect", o.time_precision == "isostring"
    nullable = kind.optional or o.override_datetime_to_nullable
    if k in ("int16", "int32", "int64"):
        return s.cast({"int16": "smallint", "int32": "int", "int64": "bigint"}[k])
    if k == "float":
        return s.cast("float").cast("double")
    if k == "double":
        return s.cast("double")
    if k == "uint64":
        return uint64(s, o.uint64)
    if k == "string":
        return s
    if k == "enum":
        return enum_value(s, kind.options)
    if k == "set":
        return F.when(s.rlike(r"^[0-9]+$"), set_labels(uint64(s, "long"), kind.options)).otherwise(s)
    if k == "binary":
        return binary_value(cell, o.binary)
    if k == "bit":
        return bit_value(cell, kind.length)
    if k == "time":
        return s if iso else F.floor(time_micros(s) / 1000).cast("bigint") if connect else time_micros(s)
    if k == "date":
        if iso:
            return s
        return date_value(s) if nullable else F.coalesce(date_value(s), F.lit("1970-01-01").cast("date"))
    if k == "datetime":
        if iso:
            return s
        n = datetime_number(datetime_value(s), kind.length or 0, o.time_precision)
        return n if nullable else F.coalesce(n, F.lit(0).cast("bigint"))
    if k == "timestamp":
        if connect:
            n = F.unix_millis(timestamp_value(s))
            return n if kind.optional else F.coalesce(n, F.lit(0).cast("bigint"))
        n = iso_timestamp(timestamp_value(s), kind.length or 0)
        return n if kind.optional else F.coalesce(n, F.lit("1970-01-01T00:00:00Z"))
    return cell if o.include_unknown else None


def pack(cells: list[Column]) -> Column:
    """The packed row of text cells: the inverse of ``unpack``."""
    raw = [c.cast("string").cast("binary") for c in cells]
    return F.struct(F.array(*(F.coalesce(F.length(r), F.lit(-1)).cast("bigint") for r in raw)).alias("lengths"), F.concat(*(F.coalesce(r, F.lit(b"")) for r in raw)).alias("values"))
