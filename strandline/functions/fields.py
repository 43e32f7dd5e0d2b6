"""Scalar parsing helpers: identifiers, nullable casts, INFO and FORMAT fields, times and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_identifier(name: Column | str) -> Column:
    """Lower case, every run of other characters one underscore, none at the ends, no leading digit."""
    s = F.trim(F.regexp_replace(F.lower(_col(name)), "[^a-z0-9]+", " "))
    s = F.regexp_replace(s, " ", "_")
    return F.when(s == "", "funknown").when(s.rlike("^[0-9]"), F.concat(F.lit("_"), s)).otherwise(s)


def clean_key(name: Column | str, spare: str = "unknown", keep: str = "") -> Column:
    """Identifier policy of section keys: case kept unless folded by the caller, ``keep`` characters survive."""
    s = F.regexp_replace(F.trim(_col(name)), f"[^A-Za-z0-9{keep}]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.when(s == "", spare).otherwise(s)


def whole(text: Column | str) -> Column:
    """Nullable integer: '' and '.' and anything else unreadable are null."""
    return F.trim(_col(text)).try_cast("bigint")


def real(text: Column | str) -> Column:
    """Nullable double; NA, nan and other words are null, infinities stay."""
    d = F.trim(_col(text)).try_cast("double")
    return F.when(~F.isnan(d), d)


def whole_list(text: Column | str, sep: str = ",") -> Column:
    """The readable integers of a separated list."""
    return F.filter(F.transform(F.split(_col(text), sep), lambda x: F.trim(x).try_cast("bigint")), lambda x: x.isNotNull())


def real_list(text: Column | str, sep: str = ",") -> Column:
    """The readable numbers of a separated list."""
    return F.filter(F.transform(F.split(_col(text), sep), lambda x: F.trim(x).try_cast("double")), lambda x: x.isNotNull() & ~F.isnan(x))


def first_whole(text: Column | str, sep: str = ",") -> Column:
    """The first entry of a list if it is an integer."""
    return F.trim(F.split(_col(text), sep)[0]).try_cast("bigint")


def info_map(text: Column | str) -> Column:
    """'k=v;flag' as a map; flags map to '', the last of a repeated key wins, '.' and '' are empty.

    Repeated keys are resolved here, so the session's map policy doesn't matter.
    """
    items = F.filter(F.split(F.coalesce(_col(text), F.lit("")), ";"), lambda x: (x != "") & (x != "."))
    pairs = F.transform(items, lambda x: F.struct(F.split(x, "=", 2)[0].alias("key"), F.coalesce(F.try_element_at(F.split(x, "=", 2), F.lit(2)), F.lit("")).alias("value")))
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), p["value"].alias("value"), i.alias("i"))), lambda p: p["key"].isNotNull())
    kept = F.filter(last, lambda p: ~F.exists(last, lambda q: (q["key"] == p["key"]) & (q["i"] > p["i"])))
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["key"], p["value"])))


def sample_fields(names: Column | str, values: Column | str) -> Column:
    """FORMAT keys zipped with one sample's values, as long as both last."""
    k, v = F.split(_col(names), ":"), F.split(_col(values), ":")
    n = F.least(F.size(k), F.size(v))
    return F.map_from_arrays(F.slice(k, 1, n), F.slice(v, 1, n))


def event_type(alt: Column | str, copies: Column | str, info: Column | str) -> Column:
    """DEL, DUP or REF: INFO's SVTYPE first, then the copy number against 2, then the ALT text."""
    alt, copies, info = _col(alt), _col(copies), _col(info)
    n = copies.cast("string").try_cast("int")
    return (
        F.when(F.coalesce(info["SVTYPE"], F.lit("")) != "", info["SVTYPE"])
        .when(n < 2, "DEL").when(n > 2, "DUP").when(n == 2, "REF")
        .otherwise(F.when(alt.isNull() | alt.isin("", "."), "REF").otherwise(F.regexp_replace(alt, "[<>]", "")))
    )


def epoch_time(value: Column | str) -> Column:
    """Seconds, milli-, micro- or nanoseconds by magnitude, else an ISO text; a timestamp."""
    n = F.trim(_col(value).cast("string")).try_cast("double")
    size = F.abs(n)
    seconds = F.when(size < 1e11, n).when(size < 1e14, n / 1e3).when(size < 1e17, n / 1e6).otherwise(n / 1e9)
    return F.when(n.isNotNull(), F.timestamp_micros((seconds * 1e6).cast("bigint"))).otherwise(_col(value).cast("string").try_cast("timestamp"))


def duration_text(seconds: Column | str) -> Column:
    """'2d 03:04:05' or '03:04:05' (P17)."""
    s = _col(seconds).cast("bigint")
    clock = F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in (F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60), s % 60)])
    return F.when(s >= 86400, F.concat(F.floor(s / 86400).cast("string"), F.lit("d "), clock)).otherwise(clock)


def size_bytes(text: Column | str) -> Column:
    """'1.5G', '200 MB', '7' as bytes, powers of 1024."""
    t = F.upper(F.trim(_col(text)))
    n = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    unit = F.regexp_extract(t, r"^[0-9.]+\s*([KMGTP]?)I?B?$", 1)
    power = F.when(unit == "K", 1).when(unit == "M", 2).when(unit == "G", 3).when(unit == "T", 4).when(unit == "P", 5).otherwise(0)
    return F.when(t.rlike(r"^[0-9]+(\.[0-9]+)?\s*[KMGTP]?I?B?$"), (n * F.pow(F.lit(1024.0), power)).cast("bigint"))


def read_group_name(name: Column | str) -> Column:
    """Drop a last-but-one '_' token of 1 or 3."""
    return F.regexp_replace(_col(name), "^(.*)_(?:1|3)_([^_]*)$", "$1_$2")


def read_name(name: Column | str) -> Column:
    """First word without a leading @ and a trailing /1 or /2."""
    return F.regexp_replace(F.regexp_replace(F.split(_col(name), r"\s")[0], "^@", ""), "/[12]$", "")


def with_prefix(path: Column | str, prefix: str) -> Column:
    """Relative paths below ``prefix``; absolute ones and ones with a protocol as they are."""
    p = _col(path)
    return F.when(p.startswith("/") | p.contains("://"), p).otherwise(F.concat(F.lit(prefix.rstrip("/") + "/"), p))


def protocol(path: Column | str) -> Column:
    """What stands before '://', '' if nothing does."""
    return F.regexp_extract(_col(path), "^([A-Za-z0-9+.-]+)://", 1)


def common_stem(names: Column | str, least: int = 8) -> Column:
    """Longest common prefix of an array of base names if it is longer than ``least``."""
    bases = F.transform(_col(names), lambda x: F.regexp_replace(x, "^.*/", ""))
    low, high = F.array_min(bases), F.array_max(bases)
    same = F.length(low) - F.length(F.regexp_replace(low, "(?s).*", ""))
    steps = F.sequence(F.lit(0), F.least(F.length(low), F.length(high)))
    n = F.array_max(F.filter(steps, lambda k: F.substring(low, F.lit(1), k) == F.substring(high, F.lit(1), k)))
    return F.when((same >= 0) & (n > least), F.substring(low, F.lit(1), n))


def phase_code(text: Column | str) -> Column:
    """'123+4ACGT|A' as struct<pos,ref_len,left,right,phased>; without '+n' the reference length is 1."""
    t = _col(text)
    pattern = r"^([0-9]{3})(?:\+([0-9]+))?([A-Za-z*.<>-]*)([|!])([A-Za-z*.<>-]*)$"
    part = lambda k: F.regexp_extract(t, pattern, k)
    return F.when(
        t.rlike(pattern),
        F.struct(
            part(1).cast("int").alias("pos"), F.coalesce(part(2).try_cast("int"), F.lit(1)).alias("ref_len"),
            part(3).alias("left"), part(5).alias("right"), (part(4) == "|").alias("phased"),
        ),
    )


def phase_text(pos: Column, ref_len: Column, left: Column, right: Column, phased: Column) -> Column:
    """The packed form of a phased genotype."""
    return F.concat(
        F.lpad((pos % 1000).cast("string"), 3, "0"), F.when(ref_len > 1, F.concat(F.lit("+"), ref_len.cast("string"))).otherwise(""),
        left, F.when(phased, "|").otherwise("!"), right,
    )


def nearest_position(packed: Column | str, near: Column | str) -> Column:
    """Complete a three-digit position to the one nearest to ``near``."""
    p, at = _col(packed), _col(near)
    base = at - at % 1000 + p
    options = F.array(base - 1000, base, base + 1000)
    return F.array_min(F.transform(options, lambda x: F.struct(F.abs(x - at).alias("d"), x.alias("x"))))["x"]
