"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, and perplexity under it.

The model is over runs of four UTF-16 units, one for each language. Each task packs the documents it reads into
compressed portions, and these into blocks of bounded size. A block sends each of its different runs once, with its
count in trusted texts; counts and continuation counts are summed by hash of the run, and probabilities come
from joins on these shards, order by order. Then each block gets the probabilities of its own runs and scores
its documents. So no task holds the model, what moves grows with the input, and a frequent run is one row for each
block. Texts are written once, packed and in buckets of blocks; ids of trusted documents and probabilities move to them.

Very long texts are a block of their own and are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import portions, small_batches
from sluice.session import cut_lineage, cut_lineage_by

ORDER = 4
BITS = 16
# Bytes of text of a block.
BLOCK_BYTES = 48 << 20
# Packed texts are staged once and read twice, so they are packed well.
PACK_LEVEL = 6
# Documents beyond this quantile of trusted perplexity, times the margin, are dropped.
QUANTILE = 0.99
MARGIN = 1.1


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs that end at each UTF-16 unit of each text, and how many each text has.

    Three start marks stand before a text. A character beyond 16 bits is two units, so all are told apart.
    """
    units = [t.encode("utf-16-le", "surrogatepass") for t in texts]
    lengths = np.fromiter(map(len, units), np.int64, len(units)) // 2
    joined = ("\2" * (ORDER - 1)).encode("utf-16-le").join([b"", *units])
    chars = np.frombuffer(joined, np.uint16).astype(np.uint64)
    if len(chars) < ORDER:
        return np.empty(0, np.int64), lengths
    code = np.zeros(len(chars) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        code = code << np.uint64(BITS) | chars[i : i + len(code)]
    # Runs that end in the marks before the next text are no text's own.
    ends = np.cumsum(lengths + ORDER - 1)
    own = np.ones(len(code), bool)
    for back in range(1, ORDER):
        own[ends[:-1] - back] = False
    return code[own].view(np.int64), lengths


def _rows(table: pa.Table) -> list[tuple[str, np.ndarray]]:
    langs = table["lang"].to_pylist()
    return [(lang, np.array([i for i, x in enumerate(langs) if x == lang])) for lang in sorted(set(langs))]


def _distinct(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    kinds, place = np.unique(np.concatenate(codes), return_inverse=True)
    return kinds, np.bincount(place, np.concatenate(counts), len(kinds)).astype(np.int64)


PACKED = "block long, ids array<long>, packed binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, ids, packed): the documents of a batch, compressed; batches of a task up to ``BLOCK_BYTES`` are a block."""
    block, held = TaskContext.get().partitionId() << 24, 0
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=PACK_LEVEL))
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.sum(pc.binary_length(batch["text"])).as_py()
        if held and held + size > BLOCK_BYTES:
            block, held = block + 1, 0
        held += size
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
            out.write_batch(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([batch["doc_id"].to_pylist()], pa.list_(pa.int64())), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["block", "ids", "packed"],
        )


def _unpacked(docs: pa.Table) -> Iterator[pa.Table]:
    """(doc_id, lang, text): the portions of a block, one after another."""
    for packed in docs["packed"]:
        yield pa.ipc.open_stream(packed.as_buffer()).read_all()


def _inventory(key: tuple, docs: pa.Table, trusted: pa.Table) -> pa.Table:
    """(block, lang, run, count): the different runs of a block and how often its trusted texts hold them."""
    held: dict[str, tuple[list, list]] = {}
    ids = trusted["doc_id"].combine_chunks()
    for portion in _unpacked(docs):
        for lang, at in _rows(portion):
            mine = portion.take(pa.array(at))
            texts, known = mine["text"].to_pylist(), pc.is_in(mine["doc_id"], value_set=ids).to_numpy().astype(np.int64)
            codes, counts = held.setdefault(lang, ([], []))
            for a, b in portions(texts, 1 << 20):
                found, lengths = runs(texts[a:b])
                kinds, place = np.unique(found, return_inverse=True)
                codes.append(kinds)
                counts.append(np.bincount(place, np.repeat(known[a:b], lengths), len(kinds)).astype(np.int64))
            if len(codes) > 8:
                kinds, sums = _distinct(codes, counts)
                held[lang] = ([kinds], [sums])
    found = [(lang, *_distinct(codes, counts)) for lang, (codes, counts) in held.items() if codes]
    n = sum(len(kinds) for _, kinds, _ in found)
    join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
    return pa.table({
        "block": pa.array(np.full(n, key[0].as_py(), np.int64)), "lang": join([np.full(len(k), lang, object) for lang, k, _ in found], pa.string()),
        "run": join([k for _, k, _ in found], pa.int64()), "count": join([c for _, _, c in found], pa.int64()),
    })


def _score(key: tuple, docs: pa.Table, known: pa.Table) -> pa.Table:
    """(doc_id, lang, n_chars, log_p): summed log probability of each document of a block."""
    ids, langs, sizes, sums = [], [], [], []
    tables = {}
    for lang, at in _rows(known) if known.num_rows else ():
        code, log_p = (known[c].take(pa.array(at)).to_numpy() for c in ("run", "log_p"))
        by = np.argsort(code)
        tables[lang] = code[by], log_p[by]
    for portion in _unpacked(docs):
        for lang, at in _rows(portion):
            mine = portion.take(pa.array(at))
            texts = mine["text"].to_pylist()
            ids += mine["doc_id"].to_pylist()
            langs += [lang] * len(texts)
            for a, b in portions(texts, 1 << 20):
                found, lengths = runs(texts[a:b])
                total = np.zeros(b - a)
                some = np.flatnonzero(lengths)
                if len(some):
                    code, log_p = tables[lang]
                    starts = np.cumsum(lengths) - lengths
                    total[some] = np.add.reduceat(log_p[np.searchsorted(code, found)], starts[some])
                sizes.append(np.fromiter(map(len, texts[a:b]), np.int64, b - a))
                sums.append(total)
    join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()),
        "n_chars": join(sizes, pa.int64()), "log_p": join(sums, pa.float64()),
    })


def _suffix(run: Column, order: int) -> Column:
    return run.bitwiseAND((1 << BITS * order) - 1) if order < ORDER else run


def _context(run: Column) -> Column:
    return F.shiftrightunsigned(run, BITS)


def probabilities(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lang, run, p) for the ``wanted`` (lang, run) of full order, from ``counts`` (lang, run, count) of trusted text.

    Full order discounts raw counts; lower orders discount continuation counts, the number of different
    characters seen before a run. Below the first order stands an even share for each character of the language.
    """
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        short = levels[order + 1].select("lang", _suffix(F.col("run"), order).alias("run"))
        levels[order] = short.groupBy("lang", "run").agg(F.count("*").alias("count"))
    chars = levels[1].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("share"))
    lower = None
    for order in range(1, ORDER + 1):
        table = levels[order]
        number = lambda c: F.count_if(F.col("count") == c).cast("double")
        n = table.groupBy("lang").agg(*[number(i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        # Counts too few to estimate a discount fall back to the usual 0.5, 1, 1.5.
        discount = lambda i, d: F.coalesce(
            F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0), F.greatest(F.lit(0.1), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))),
            F.lit(d),
        )
        n = n.select("lang", *[discount(i, i / 2).alias(f"d{i}") for i in (1, 2, 3)])
        contexts = (
            table.groupBy("lang", _context(F.col("run")).alias("context"))
            .agg(F.sum("count").alias("total"), *[F.count_if(c).alias(f"m{i}") for i, c in ((1, F.col("count") == 1), (2, F.col("count") == 2), (3, F.col("count") > 2))])
            .join(n, "lang")
            .select("lang", "context", "total", "d1", "d2", "d3", ((F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")).alias("rest"))
        )
        asked = wanted.select("lang", _suffix(F.col("run"), order).alias("run")).distinct()
        asked = asked.withColumn("context", _context(F.col("run"))).withColumn("shorter", _suffix(F.col("run"), order - 1) if order > 1 else F.lit(0).cast("long"))
        joined = asked.join(table, ["lang", "run"], "left").join(contexts, ["lang", "context"], "left")
        if lower is None:
            joined = joined.join(chars.withColumnRenamed("share", "q"), "lang", "left").withColumn("q", F.coalesce("q", F.lit(1 / 256)))
        else:
            joined = joined.join(lower.toDF("lang", "shorter", "q"), ["lang", "shorter"])
        c = F.col("count")
        held = F.when(c.isNull(), 0.0).otherwise(
            F.greatest(F.lit(0.0), c - F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))) / F.col("total")
        )
        p = F.when(F.col("total").isNull(), F.col("q")).otherwise(held + F.col("rest") * F.col("q"))
        lower = joined.select("lang", "run", p.alias("p"))
    return lower


def perplexities(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(doc_id, lang, n_chars, log_p): one row per input row. ``labels`` has the ids of trusted documents (doc_id).

    All of them train the model. A null or empty text has no
    characters and log_p 0; a null language is the empty one. Repeated rows stay, and count as often in the
    model; rows with a null id are scored, never trusted.
    """
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    packed = cut_lineage_by(read.mapInArrow(_pack, PACKED), "block")
    ids = labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    trusted = packed.select(F.col("block").alias("at"), F.explode("ids").alias("doc_id")).join(ids, "doc_id", "left_semi")
    trusted = trusted.select(F.col("at").alias("block"), "doc_id")
    blocks = packed.select("block", "packed").groupBy("block")
    inventory = cut_lineage(blocks.cogroup(trusted.groupBy("block")).applyInArrow(_inventory, "block long, lang string, run long, count long"))
    kinds = cut_lineage(inventory.groupBy("lang", "run").agg(F.sum("count").alias("count")))
    model = cut_lineage(probabilities(kinds.where("count > 0"), kinds.select("lang", "run")))
    known = inventory.join(model, ["lang", "run"]).select("block", "lang", "run", F.log("p").alias("log_p"))
    schema = T.StructType().add("doc_id", "long").add("lang", "string").add("n_chars", "long").add("log_p", "double")
    return blocks.cogroup(known.groupBy("block")).applyInArrow(_score, schema)


def classify(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, threshold, kept): one row per input row.

    ``labels`` (doc_id, quality) names the trusted documents by quality 1; they train the model, and the
    perplexities of all of them give each language its threshold: ``quantile`` of them, times ``margin``. A document without
    characters has no perplexity and is not kept. A language without trusted text has no threshold and keeps all.
    """
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    scored = cut_lineage(perplexities(docs, trusted, id_col, text_col, lang_col))
    scored = scored.withColumn("perplexity", F.when(F.col("n_chars") > 0, F.exp(-F.col("log_p") / F.col("n_chars"))))
    limits = (
        scored.join(trusted, "doc_id", "left_semi")
        .groupBy("lang")
        .agg((F.percentile_approx("perplexity", quantile, 10_000) * margin).alias("threshold"))
    )
    kept = F.coalesce(F.col("perplexity") <= F.coalesce("threshold", F.lit(float("inf"))), F.lit(False))
    return scored.join(limits, "lang", "left").select("doc_id", "lang", "n_chars", "perplexity", "threshold", kept.alias("kept"))
