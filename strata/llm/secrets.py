"""Secret scan with multipart credential linking, in DataFrame and SQL functions only.

Strong candidates are reported wherever they stand: assignments to a secret's name,
access key identifiers and long hexadecimal runs. Weak candidates (account names, runs
of 40 mixed characters, endpoints) say nothing alone; an interval join within the scope
of a document, ``SCOPE`` code points around a complementary part, reports those that
co-occur with one and names the nearest partner.

Positions come from the pieces between matches: a match starts after the pieces and
matches before it, a running sum over one document and kind. Texts are read once and not
shuffled; only spans are. The interval join is an equi-join on document and stretch of
``SCOPE`` code points; spans of one kind do not overlap, so a stretch holds a bounded
number of them, whatever the document's length.

Defined cases: NULL and empty texts have no span; repeated rows are separate documents,
told apart by a row number; offsets are code points; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage

SCOPE = 256


def either_case(word: str) -> str:
    """A pattern for an ASCII word in any mixture of cases."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _names(*words: str) -> str:
    return "(" + "|".join(either_case(w) for w in words).replace("~", "?") + ")"


_SECRET = _names("password", "passwd", "secret", "token", "api_~key")
_ACCOUNT = _names("username", "user", "login", "client_id", "account")
_PLACE = _names("endpoint", "host", "server")
# Kinds in order of report: pattern, and what else a match must satisfy.
KINDS = {
    "assign": (_SECRET + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "group"),
    "access": (r"AKIA[A-Z0-9]{16,}", None),
    "hex": (r"[0-9a-f]{24,}", None),
    "user": (_ACCOUNT + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]+""", None),
    "key": (r"[A-Za-z0-9+/]{40,}", "mixed"),
    "endpoint": (r"[Hh][Tt][Tt][Pp][Ss]?://[A-Za-z0-9./:_?&=%-]+|" + _PLACE + r"\x20*[:=]\x20*[A-Za-z0-9.:-]+", None),
}
ORDER = {kind: i for i, kind in enumerate(KINDS)}
BASE = ("assign", "access", "hex")
LEAST_VALUE = 6
# A weak kind is reported beside one of these.
COMPLEMENTS = {"user": ("assign", "hex", "key"), "key": ("access", "user", "endpoint"), "endpoint": ("assign", "access", "key")}


def _accepted(match: Column, kind: str) -> Column:
    pattern, rule = KINDS[kind]
    if rule == "group":
        return F.length(F.regexp_extract(match, pattern, 2)) >= LEAST_VALUE
    if rule == "mixed":
        return (F.length(match) == 40) & match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")
    return F.lit(True)


def _pieces(kind: str) -> Column:
    """Of every match of a kind: the length of the piece before it, its own, and whether it counts."""
    pattern = KINDS[kind][0]
    matches, gaps = F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1)
    pairs = F.zip_with(
        matches, F.slice(gaps, F.lit(1), F.size(matches)),
        lambda match, gap: F.struct(
            F.lit(ORDER[kind]).alias("kind"), F.length(gap).alias("gap"), F.length(match).alias("size"),
            _accepted(match, kind).alias("ok")))
    numbered = F.transform(pairs, lambda p, i: F.struct(
        p["kind"].alias("kind"), i.alias("n"), p["gap"].alias("gap"), p["size"].alias("size"), p["ok"].alias("ok")))
    return F.when(F.col("text").rlike(pattern), numbered).otherwise(
        F.array().cast("array<struct<kind:int,n:int,gap:int,size:int,ok:boolean>>"))


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents ``__row, doc_id``, and accepted spans ``__row, kind, start, stop`` of all kinds."""
    text = docs.select(F.monotonically_increasing_id().alias("__row"), "doc_id", "text")
    pieces = cut_lineage(
        text.select("__row", "doc_id", F.concat(*[_pieces(k) for k in KINDS]).alias("pieces")), "secret-pieces")
    sofar = Window.partitionBy("__row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    spans = pieces.select("__row", F.explode("pieces").alias("p")).select("__row", "p.*")
    stop = F.sum(F.col("gap").cast("long") + F.col("size")).over(sofar)
    spans = spans.withColumn("stop", stop).filter("ok").select(
        "__row", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop")
    return pieces.select("__row", "doc_id"), spans


def links(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak spans beside a complementary part, with the nearest: ``..., distance, partner``."""
    pairs = F.create_map(*[x for weak, others in COMPLEMENTS.items()
                           for x in (F.lit(ORDER[weak]), F.array(*[F.lit(ORDER[o]) for o in others]))])
    weak = spans.filter(F.col("kind").isin([ORDER[k] for k in COMPLEMENTS])).select(
        "*", F.floor(F.col("start") / scope).alias("stretch"))
    reach = F.sequence(F.floor(F.greatest(F.col("start") - scope, F.lit(0)) / scope),
                       F.floor((F.col("stop") + scope) / scope))
    parts = spans.select(
        F.col("__row").alias("__other"), F.col("kind").alias("other_kind"), F.col("start").alias("other_start"),
        F.col("stop").alias("other_stop"), F.explode(reach).alias("other_stretch"))
    distance = F.greatest(
        F.col("other_start") - F.col("stop"), F.col("start") - F.col("other_stop"), F.lit(0))
    near = weak.join(
        parts,
        (F.col("__row") == F.col("__other")) & (F.col("stretch") == F.col("other_stretch"))
        & F.array_contains(pairs[F.col("kind")], F.col("other_kind"))
        & (F.col("other_start") <= F.col("start") + scope) & (F.col("other_stop") >= F.col("start") - scope))
    near = near.withColumn("partner", F.struct(
        distance.alias("distance"), F.col("other_kind").alias("kind"),
        F.col("other_start").alias("start"), F.col("other_stop").alias("stop")))
    return near.groupBy("__row", "kind", "start", "stop").agg(F.min("partner").alias("partner"))


def _listed(entries: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(entries), lambda e: e["text"]))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: counts by strong kind, all spans, a digest of the strong ones, and links."""
    rows, spans = candidates(docs)
    strong = spans.filter(F.col("kind") < len(BASE)).withColumn(
        "partner", F.lit(None).cast("struct<distance:bigint,kind:int,start:bigint,stop:bigint>"))
    reported = strong.unionByName(links(spans, scope))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    entry = F.struct("start", "kind", F.concat_ws(":", name, "start", "stop").alias("text"))
    base = F.col("kind") < len(BASE)
    found = reported.groupBy("__row").agg(
        *[F.count(F.when(F.col("kind") == ORDER[k], 1)).alias(f"n_{k}") for k in BASE],
        F.count(F.when(~base, 1)).alias("n_linked"),
        F.collect_list(F.when(base, entry)).alias("base"), F.collect_list(entry).alias("all"),
        F.collect_list(F.when(~base, F.struct("start", "stop", "kind", "partner"))).alias("links"))
    joined = rows.join(found, "__row", "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
              for c in (*[f"n_{k}" for k in BASE], "n_linked")]
    return joined.select(
        "doc_id", *counts[:-1],
        F.sha2(F.coalesce(_listed(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("all")), F.lit("")).alias("spans"), counts[-1],
        F.coalesce(F.size("links"), F.lit(0)).alias("n_links"), F.array_sort("links").alias("links"))
