"""Secret scans with corpus-wide ownership frequency.

Every whole text is searched for credential candidates. Each candidate value is hashed, and over
the whole corpus it is counted in how many repositories and by how many owners it occurs. A value
that several owners share is a copied example (documentation, tutorials, mirrors); one that stays
with a single owner and looks random is taken for live. Assignments, access keys and hex runs are
always reported; further kinds only where ownership makes them live-looking.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.llm import common

# The kinds of span in report order, and what each looks like.
KINDS = ("assign", "access", "hex", "key", "token", "opaque")
BASE = KINDS[:3]
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this equals [0-9a-f]+ of 24 or more
# Up to its END; without one before the next BEGIN, up to the last line of base64 that follows.
KEY = re.compile(
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END (?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:\s|\\[nr])*[A-Za-z0-9+/]{16,}={0,2})*)")
TOKEN = re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_-]{24,}+(?:={1,2}(?![A-Za-z0-9+/_.=-]))?(?!\.[A-Za-z0-9+/_-])")
PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|changeme|placeholder|your_|xxxx|1234567|abcdef0|(.)\1{7}", re.A)

MIN_ASSIGN, MIN_ACCESS, MIN_ENTROPY = 6, 20, 3.0
MAX_OWNERS = 1

SPANS = pa.list_(pa.struct([
    ("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
    ("value", pa.string()), ("random", pa.bool_())]))
SPANS_SQL = "array<struct<start:bigint,kind:int,end:bigint,value:string,random:boolean>>"


def entropy(value: str) -> float:
    counts = Counter(value).values()
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts)


def looks_random(value: str) -> bool:
    """Long and varied enough for a credential, and no placeholder."""
    return len(value) >= 12 and entropy(value) >= MIN_ENTROPY and not PLACEHOLDER.search(value)


def looks_chosen(value: str) -> bool:
    """Varied enough for its length, and no placeholder: what is assigned by name may be short."""
    return entropy(value) >= min(MIN_ENTROPY, 0.8 * math.log2(len(value))) and not PLACEHOLDER.search(value)


def looks_opaque(value: str) -> bool:
    """Random with digits and both cases; with slashes, also mixed as base64 is and paths are not."""
    kinds = ["/" if c == "/" else "0" if c.isdigit() else "a" if c.islower() else "A" for c in value]
    return {"0", "a", "A"} <= set(kinds) and looks_random(value) and (
        "/" not in kinds or 3 * sum(a != b and "/" not in (a, b) for a, b in zip(kinds, kinds[1:])) >= len(value))


def spans_of(text: str) -> list[dict]:
    """All candidate spans of a text, by start and then kind. Places are code points."""
    found = []

    def add(kind: str, start: int, end: int, value: str) -> None:
        random = kind == "key" or (looks_chosen if kind == "assign" else looks_random)(value)
        found.append({"start": start, "kind": KINDS.index(kind), "end": end, "value": value, "random": random})

    for m in ASSIGN.finditer(text):
        if len(m[2]) >= MIN_ASSIGN:
            add("assign", *m.span(), m[2])
    for m in ACCESS.finditer(text):
        if len(m[0]) >= MIN_ACCESS:
            add("access", *m.span(), m[0])
    for m in HEX.finditer(text):
        add("hex", *m.span(), m[0])
    for kind, pattern in (("key", KEY), ("token", TOKEN), ("opaque", OPAQUE)):
        # Spans found so far by start, with the furthest end up to each; those of one pattern are apart.
        taken = sorted((s["start"], s["end"]) for s in found)
        starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
        for m in pattern.finditer(text):
            before = bisect_left(starts, m.end())  # spans that begin before this one ends
            # What stands inside a private key does not hide the key.
            if kind != "key" and before and reach[before - 1] > m.start():
                continue
            if kind == "opaque" and not looks_opaque(m[0]):
                continue
            # A private key is the same in whatever lines it stands.
            value = hashlib.sha256("".join(m[0].split()).encode("utf-8", "replace")).hexdigest() if kind == "key" else m[0]
            add(kind, *m.span(), value)
    return sorted(found, key=lambda s: (s["start"], s["kind"]))


def find_spans(text: Column) -> Column:
    """The candidate spans of a text column, found in Arrow batches."""
    @F.arrow_udf(SPANS_SQL)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([spans_of(t.as_py()) for t in texts], SPANS)

    return find(text)


def judged(found: DataFrame) -> DataFrame:
    """`found` (row, source, spans) with each span judged: row, spans with value_sha256,
    owners, repositories and live.

    Ownership is counted over distinct (value, owner, repository), combined before each shuffle,
    so a value that a third of the corpus copies is a few rows. Joining the counts back is a
    join AQE can split.
    """
    owner = F.regexp_extract("source", "^[^/]*", 0)
    one = common.written(found.where(F.size("spans") > 0).select("row", "source", F.explode("spans").alias("s")).select(
        "row", "s", F.unhex(F.sha2("s.value", 256)).alias("value"),
        owner.alias("owner"), F.col("source").alias("repository")), "spans")
    seen = one.groupBy("value", "owner", "repository").agg(F.lit(1).alias("seen"))
    counts = seen.groupBy("value").agg(
        F.countDistinct("owner").alias("owners"), F.countDistinct("repository").alias("repositories"))
    both = one.join(counts.withColumnRenamed("value", "counted"), F.col("value") == F.col("counted"))
    live = F.col("s.random") & (F.col("owners") <= MAX_OWNERS)
    return both.where(live | (F.col("s.kind") < len(BASE))).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "s.start", "s.kind", "s.end", F.lower(F.hex("value")).alias("value_sha256"),
        "owners", "repositories", live.alias("live")))).alias("spans"))


def as_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, base (spans of the three base kinds), spans (all, judged).

    A null text is empty, a null source is a repository of its own with the empty name; the owner
    is what stands before the first slash of the source. Empty texts have no spans; equal spans of
    repeated rows count once per repository. Other columns are not read. Whole texts are searched.
    """
    found = common.written(docs.select(
        common.row_id().alias("row"), "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        find_spans(common.text_of()).alias("spans")), "found")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE)).alias("base")
    spans = judged(found).withColumnRenamed("row", "judged_row")
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select("row", "doc_id", base).join(
        spans, F.col("row") == F.col("judged_row"), "left",
    ).select("doc_id", "base", F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with live-looking credentials replaced by `[SECRET]` and n_chars counted anew.

    Only rows that hold candidates are joined with the judged spans; all others pass.
    """
    found = common.written(docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), common.row_id().alias("row"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"),
        find_spans(F.coalesce(docs["text"], F.lit(""))).alias("spans")), "found")
    some = F.size("spans") > 0
    spans = judged(found).select(F.col("row").alias("judged_row"), F.filter("spans", lambda s: s["live"]).alias("live"))
    none = F.array().cast(spans.schema["live"].dataType)
    held = found.where(some).join(spans, F.col("row") == F.col("judged_row"), "left")
    # Spans may overlap; what was written up to `at` is not written again.
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done: Column, s: Column) -> Column:
        ahead = s["start"] >= done["at"]
        piece = F.substring(F.col("doc.text"), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.struct(
            F.when(ahead, F.concat(done["out"], piece, F.lit("[SECRET]"))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], s["end"]).alias("at"))

    done = F.aggregate(F.coalesce("live", none), start, step)
    text = F.concat(done["out"], F.substring(F.col("doc.text"), (done["at"] + 1).cast("int"), F.length("doc.text")))
    touched = F.size(F.coalesce("live", none)) > 0
    new = F.when(touched, text).otherwise(F.col("doc.text"))
    doc = F.col("doc").withField("text", new)
    if "n_chars" in docs.columns:
        length = F.when(touched, F.length(new)).otherwise(F.col("doc.n_chars"))
        doc = doc.withField("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return found.where(~some).select("doc.*").unionByName(held.select(doc.alias("doc")).select("doc.*"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    of_kind = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return scan(common.table(spark, sf_dir, "documents")).select(
        "doc_id", *[of_kind(i).alias(f"n_{name}") for i, name in enumerate(BASE)],
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["owners"])), F.lit(0)).cast("bigint").alias("most_owners"))
