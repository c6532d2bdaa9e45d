"""Secret scan with multipart credential linking, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What is looked for. Kinds in the order in which spans of one start are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
# Parts that mean nothing alone: a bare key of 40 characters, and the address of a service. A key may stand after the =
# of a name and before padding or a full stop.
BARE_SECRET = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])"
ENDPOINT = r"""https?://[A-Za-z0-9.-]++(?::[0-9]++)?+(?:/[^\x20\x09-\x0D"'<>]*+)?+"""
KINDS = ("assign", "access", "hex", "linked_secret", "linked_endpoint")
# Characters between parts of one credential.
SCOPE = 300

SPAN = "struct<start:int,kind:int,end:int>"


def spans_of(text: Column, pattern: str, kind: int, value_group: int | None = None, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (start, kind, end), in code points, in one row.

    Spark gives no positions of matches, so they are summed up from the texts between and in the matches. With
    ``value_group``, matches whose group is shorter than ``least`` are dropped after matching.
    """
    p = F.lit(pattern)
    values = F.regexp_extract_all(text, p, F.lit(value_group if value_group is not None else 0))
    steps = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(values)), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length).alias("size"),
        F.transform(values, F.length).alias("value"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def add(so_far: Column, step: Column) -> Column:
        start = so_far["at"] + step["gap"]
        end = start + step["size"]
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        found = so_far["found"]
        return F.struct(end.alias("at"), F.when(step["value"] >= least, F.concat(found, span)).otherwise(found).alias("found"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("found")), add, lambda x: x["found"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def linked_parts(access: Column, secrets: Column, endpoints: Column, scope: int) -> Column:
    """Weak parts with what completes them within ``scope`` characters: a sweep over the parts by start, both ways.

    A bare secret counts if an access identifier is near, an endpoint if both an access identifier and a secret
    (bare or assigned) are. Each sweep remembers the nearest part of each sort, so it is linear in the parts.
    """
    parts = F.array_sort(F.concat(access, secrets, endpoints))
    far = 1 << 30

    def sort_of(p: Column) -> list[Column]:
        return [p["kind"] == 1, p["kind"].isin(0, 3), p["kind"] == 4]

    def sweep(items: Column, forward: bool) -> Column:
        names = ("a", "s", "e")
        init = F.struct(
            *(F.lit(-far if forward else far).alias(n) for n in names),
            F.array().cast(f"array<struct<span:{SPAN},a:boolean,s:boolean>>").alias("out"),
        )

        def step(acc: Column, p: Column) -> Column:
            near = [(p["start"] - acc[n] if forward else acc[n] - p["end"]) <= scope for n in names]
            seen = F.greatest if forward else F.least
            mark = p["end"] if forward else p["start"]
            return F.struct(
                *(F.when(c, seen(acc[n], mark)).otherwise(acc[n]).alias(n) for n, c in zip(names, sort_of(p), strict=True)),
                F.concat(acc["out"], F.array(F.struct(p.alias("span"), near[0].alias("a"), near[1].alias("s")))).alias("out"),
            )

        return F.aggregate(items, init, step, lambda x: x["out"])

    both = F.zip_with(
        sweep(parts, True),
        F.reverse(sweep(F.reverse(parts), False)),
        lambda x, y: F.struct(x["span"].alias("span"), (x["a"] | y["a"]).alias("a"), (x["s"] | y["s"]).alias("s")),
    )
    kept = F.filter(both, lambda x: x["a"] & ((x["span"]["kind"] == 3) | ((x["span"]["kind"] == 4) & x["s"])))
    return F.transform(kept, lambda x: x["span"])


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """The documents with ``base`` and ``linked`` added: arrays of (start, kind, end) spans; kind is a place in KINDS.

    Base spans are assigned values, access identifiers and long hexadecimal runs. Linked spans are weak parts, bare
    keys and endpoints, reported only if the parts that complete them stand within ``scope`` characters; those that
    overlap a base span are left out. Positions are code points, the end is exclusive.

    All is done row by row without a shuffle, on whole texts; texts without a match cost three scans. Null text counts
    as empty and gives no spans. Repeated rows are scanned each; other columns pass through (columns named base or
    linked are replaced). No rows give no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    kinds = docs.withColumns({
        "__assign": spans_of(body, ASSIGN, 0, 2, LEAST_VALUE),
        "__access": spans_of(body, ACCESS, 1),
        "__hex": spans_of(body, HEX, 2),
    })
    based = kinds.withColumn("base", F.array_sort(F.concat("__assign", "__access", "__hex")))
    weak = based.withColumns({
        "__secret": F.when(F.size("__access") > 0, spans_of(body, BARE_SECRET, 3)).otherwise(none),
        "__endpoint": F.when(F.size("__access") > 0, spans_of(body, ENDPOINT, 4)).otherwise(none),
    })
    found = weak.withColumn(
        "__found",
        F.when(
            F.size("__secret") + F.size("__endpoint") > 0,
            linked_parts(F.concat("__access", "__assign"), F.col("__secret"), F.col("__endpoint"), scope),
        ).otherwise(none),
    )
    apart = F.filter(
        "__found", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return found.withColumn("linked", F.when(F.size("__found") > 0, apart).otherwise(none)).drop(
        "__assign", "__access", "__hex", "__secret", "__endpoint", "__found"
    )


def number_of(spans: str, kind: int) -> Column:
    """Spans of one kind in a column of spans. (A second parameter of the lambda would be the span's place.)"""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
