"""Secret scan: patterns in whole texts, and corpus-wide ownership of each candidate.

Candidates are hashed where they are found. Over the whole corpus each hash is counted by the documents
(repositories) and sources (owners) that hold it: what many owners share is a copied example, what stays
with few is a live-looking credential.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import small_batches
from sluice.session import cut_lineage

# Base kinds, always reported. (pattern, group that is the secret, least length of that group)
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
# Further kinds, set apart as copied where their owners are many. (pattern, group that is the secret)
MORE = {
    "github": (r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0),
    "google": (r"\bAIza[0-9A-Za-z_-]{35}", 0),
    "slack": (r"\bxox[abprs]-[0-9A-Za-z-]{10,}", 0),
    "jwt": (r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0),
    "bearer": (r"\bBearer\x20+([A-Za-z0-9._~+/-]{16,}=*)", 1),
    "url": (r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:@/]{1,64}:([^\s:@/]{6,128})@", 1),
    # The span is the header, the secret is the key behind it.
    "pem": (r"-----BEGIN(?: [A-Z]+){0,3} PRIVATE KEY-----(?=([^-]*))", 1),
}
KINDS = [*BASE, *MORE]
# A candidate of more owners than this is a copied example.
OWNERS = 2

SPAN = "struct<kind:int,start:bigint,end:bigint,secret:bigint>"


def find(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, hash of the secret) of each candidate, by start and kind; places are code points."""
    low = text.lower()
    out = []
    for place, kind in enumerate(KINDS):
        if kind == "assign" and not any(w in low for w in ("passw", "secret", "token", "api")):
            continue
        least = BASE[kind][2] if kind in BASE else 1
        group = _GROUPS[kind]
        for m in _PATTERNS[kind].finditer(text):
            secret = m.group(group)
            if kind == "pem":
                secret = "".join(secret.split()) or m.group()
            if len(secret) >= least:
                out.append((place, m.start(), m.end(), xxhash.xxh64_intdigest(secret.encode()) - (1 << 63)))
    return sorted(out, key=lambda s: (s[1], s[0]))


# Letters of assignments count in either case, ASCII ones only.
_PATTERNS = {k: re.compile(v[0], re.I | re.A if k == "assign" else re.A) for k, v in (BASE | MORE).items()}
_GROUPS = {k: v[1] for k, v in (BASE | MORE).items()}


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """(id, owner, row, spans): every document with its candidates, written once."""
    small_batches(docs.sparkSession)
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("owner", T.StringType())]
    ).add("spans", T._parse_datatype_string(f"array<{SPAN}>"))
    names = ("kind", "start", "end", "secret")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.int64())]))
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in find(t.as_py() or "")] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], schema.names)

    read = docs.select(F.col(id_col), F.coalesce(F.col(owner_col).cast("string"), F.lit("")), F.col(text_col))
    return cut_lineage(read.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))


def ownership(found: DataFrame) -> DataFrame:
    """(secret, documents, owners): how many documents and owners hold each candidate.

    A candidate counts once for a document. Counts by owner come first, so an example that very many
    documents copy is combined before it moves.
    """
    held = found.select("owner", F.explode(F.array_distinct(F.transform("spans", lambda s: s["secret"]))).alias("secret"))
    by_owner = held.groupBy("secret", "owner").agg(F.count("*").alias("documents"))
    return by_owner.groupBy("secret").agg(F.sum("documents").alias("documents"), F.count("*").alias("owners"))


def scan(
    docs: DataFrame, owners: int = OWNERS, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source"
) -> DataFrame:
    """(``id_col``, spans, copied): one row per input row; each span has kind, start, end, documents, owners and live.

    ``live`` says whether at most ``owners`` owners hold the secret. ``copied`` has the spans of further kinds where that
    does not hold, ``spans`` all others. A null or empty text has no span, a null owner is the empty owner. Repeated rows and null
    ids stay; other columns are not read. Secrets leave the scan as hashes only.
    """
    found = candidates(docs, id_col, text_col, owner_col)
    known = ownership(found)
    spans = found.select("row", F.explode("spans").alias("s")).select("row", "s.*").join(known, "secret")
    spans = spans.withColumn("live", F.col("owners") <= owners)
    names = F.array(*map(F.lit, KINDS))
    each = F.struct("start", "kind", "end", F.get(names, F.col("kind")).alias("name"), "documents", "owners", "live")
    rows = spans.groupBy("row").agg(F.array_sort(F.collect_list(each)).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,name:string,documents:bigint,owners:bigint,live:boolean>>")
    own = lambda s: s["live"] | (s["kind"] < len(BASE))
    return (
        found.select("id", "row")
        .join(rows.withColumnRenamed("spans", "all"), "row", "left")
        .withColumn("all", F.coalesce("all", none))
        .select(F.col("id").alias(id_col), F.filter("all", own).alias("spans"), F.filter("all", lambda s: ~own(s)).alias("copied"))
    )


def summary(docs: DataFrame) -> DataFrame:
    """Per document: counts of base kinds, a digest of base spans, all spans, live-looking ones, and those
    of further kinds that many owners hold."""
    found = scan(docs)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    write = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(write(base).cast("binary"), 256).alias("base_sha256"),
        write(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        write(F.col("copied")).alias("copied"),
    )
