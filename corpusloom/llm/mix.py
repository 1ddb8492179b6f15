"""Problem 9: a mixture of sources at target shares of all tokens.

Method: soft-membership mixing. A classifier trained on the named documents says
with what probability each document, named or not, belongs to the target sources by
its text. Projected gradient descent on a least-squares objective then fits one rate a
document, non-negative and at most ``max_repeats`` of its source, so that expected
token totals match the targets both by text (these memberships) and by name. A name
is certain, so the totals by name come out exactly: the descent ends with steps by name
alone. Documents without a name count by text for both. The total is the largest at
which every source can reach its share; sources named in the targets but without tokens
give their share to the others in proportion. Documents of sources that are no target
stay out.

Rates become whole copies without losing the shares: a document gets the whole
part, and the first documents in a random order, in which a greater fraction comes
sooner, get one more until the source's fractions of tokens are used up. The order is
cut by a histogram of fixed size, so no source's documents are gathered; only the bucket
at the cut is ordered in full.

The classifier counts hashed character pairs of all named documents per source
(naive Bayes); its table has ``sources x 2**FEATURE_BITS`` cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.encode import encode_corpus
from corpusloom.runtime import cut_lineage

FEATURE_BITS = 12
ORDER_BUCKETS = 4096
#: Steps of the descent, and at most so many more by name alone.
STEPS = 20
#: Documents a source gets at most to fill what the cut leaves of its share.
FILL_ROUNDS = 6


def read_targets(targets: DataFrame) -> pd.DataFrame:
    """The table of targets, checked; its rows are sources, so its size is a handful."""
    rows = targets.select("source", "target_share", "max_repeats").dropDuplicates(["source"]).toPandas().dropna().sort_values("source", ignore_index=True)
    rows = rows[rows["target_share"] > 0].reset_index(drop=True)
    if rows.empty:
        raise ValueError("no source has a positive target share")
    rows["target_share"] /= rows["target_share"].sum()
    return rows


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character pairs of all texts, and the number of the text each is from."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    if len(codes) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = ((codes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    same = owner[:-1] == owner[1:]
    return hashed[same], owner[:-1][same]


def train_classifier(documents: DataFrame, sources: list[str], text_column: str, source_column: str) -> np.ndarray:
    """Log probabilities of features per source, from all named documents; the last column is the prior."""
    index = {s: k for k, s in enumerate(sources)}
    named = documents.select(source_column, text_column).where(F.col(source_column).isin(sources) & (F.length(text_column) > 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sources), (1 << FEATURE_BITS) + 1), np.int64)
        for batch in batches:
            owners = np.array([index[s] for s in batch.column(0).to_pylist()], np.int64)
            hashed, of = _features(batch.column(1).to_pylist())
            cells = np.bincount(owners[of] * (1 << FEATURE_BITS) + hashed, minlength=len(sources) << FEATURE_BITS)
            total[:, :-1] += cells.reshape(len(sources), -1)
            total[:, -1] += np.bincount(owners, minlength=len(sources))
        rows, cols = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(cols.astype(np.int32)), pa.array(total[rows, cols])], names=["s", "f", "n"])

    got = named.mapInArrow(count, "s int, f int, n bigint").groupBy("s", "f").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(sources), (1 << FEATURE_BITS) + 1))
    table[got.column("s").to_numpy(), got.column("f").to_numpy()] = got.column("n").to_numpy()
    features = table[:, :-1] + 0.5
    prior = (table[:, -1:] + 0.5) / (table[:, -1].sum() + 0.5 * len(sources))
    return np.hstack([np.log(features / features.sum(1, keepdims=True)), np.log(prior)])


def posteriors(hashed: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Membership probabilities of one text; scores are per pair so that long texts stay soft."""
    seen = np.bincount(hashed, minlength=1 << FEATURE_BITS)
    score = model[:, -1] + (model[:, :-1] @ seen / len(hashed) * min(len(hashed), 64) if len(hashed) else 0)
    p = np.exp(score - score.max())
    return p / p.sum()


def project(rate: np.ndarray, step: np.ndarray, cap: np.ndarray) -> np.ndarray:
    return np.clip(rate - step, 0, cap)


def rates_of(own: np.ndarray, p: np.ndarray, steps: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """Rates of documents after ``steps``; ``own`` is the number of a document's named source or -1, ``p`` its memberships.

    A step holds, by source, what it takes from the documents of that name, from those
    without a name by their text, and from all by their text.
    """
    named = own >= 0
    top = np.where(named, cap[own], p @ cap)
    rate = np.minimum(1.0, top)
    take = np.where(named[:, None], steps[:, 0].T[own], p @ steps[:, 1].T) + p @ steps[:, 2].T
    for k in range(len(steps)):
        rate = project(rate, take[:, k], top)
    return rate


def mixture(documents: DataFrame, targets: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", *, vocabulary: str | None = None, seed: int = 42) -> DataFrame:
    """One row per document in the mixture: id, source (null if it has none), tokens, copies.

    Null and empty texts have no tokens and stay out; repeated ids are used as often as they
    stand; an empty table gives no rows; other columns are not read. The text is read twice
    (classifier; memberships and tokens), never shuffled.
    """
    spark = documents.sparkSession
    rows = read_targets(targets)
    sources, share, cap = list(rows["source"]), rows["target_share"].to_numpy(float), rows["max_repeats"].to_numpy(float)
    wanted = documents.where(F.col(source_column).isNull() | F.col(source_column).isin(sources)).where(F.length(text_column) > 0)
    shared = spark.sparkContext.broadcast(train_classifier(documents, sources, text_column, source_column))
    kind = dict(wanted.dtypes)[id_column]

    def belong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            p = np.array([posteriors(_features([t])[0], model) for t in batch.column(2).to_pylist()]).reshape(-1)
            member = pa.ListArray.from_arrays(pa.array(np.arange(0, len(p) + 1, len(model)), pa.int32()), pa.array(p, pa.float64()))
            key = pa.StructArray.from_arrays([batch.column(0), batch.column(1), member], names=[id_column, "source", "membership"])
            yield pa.RecordBatch.from_arrays([key, batch.column(2)], names=["key", "text"])

    keyed = wanted.select(id_column, source_column, text_column).mapInArrow(belong, f"key struct<`{id_column}`: {kind}, source: string, membership: array<double>>, text string")
    counted = encode_corpus(keyed, "key", "text", vocabulary=vocabulary, ids_column="tokens", count_only=True).select("key.*", "tokens").where(F.col("tokens") > 0)
    own = F.coalesce(F.array_position(F.lit(sources), F.col("source")), F.lit(0)) - 1
    # tokens and memberships are made once; everything after reads this narrow table
    table = cut_lineage(counted.withColumn("draw", F.xxhash64(F.lit(seed), F.col(id_column))).withColumn("own", own.cast("int")))
    found = table.groupBy("source").agg(F.sum("tokens").alias("tokens")).toPandas()
    has_soft = bool(found["source"].isna().any())
    supply = np.array([float(found.loc[found["source"] == s, "tokens"].sum()) for s in sources])
    live = supply > 0
    if not live.any():
        return table.select(id_column, "source", "tokens", F.lit(0).alias("copies")).where(F.lit(False))
    share = np.where(live, share, 0) / share[live].sum()
    total = float(np.min(cap[live] * supply[live] / share[live]))
    goal = total * share

    def columns_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return batch.column("own").to_numpy(), batch.column("tokens").to_numpy(), batch.column("membership").flatten().to_numpy().reshape(batch.num_rows, -1)

    def totals(steps: np.ndarray) -> np.ndarray:
        """Per source after the given steps: expected tokens by name and by text, tokens of named documents below their most and above 0."""

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((4, len(cap)))
            for batch in batches:
                if not batch.num_rows:
                    continue
                own, tokens, p = columns_of(batch)
                rate = rates_of(own, p, steps, cap)
                named, used = own >= 0, rate * tokens
                for k, amount in ((0, used), (2, tokens * (rate < cap[own])), (3, tokens * (rate > 0))):
                    sums[k] += np.bincount(own[named], amount[named], len(cap))
                sums[0] += used[~named] @ p[~named]
                sums[1] += used @ p
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cap)), pa.int32()), *(pa.array(x) for x in sums)], names=["s", "a", "b", "c", "d"])

        got = table.select("own", "tokens", "membership").mapInArrow(fold, "s int, a double, b double, c double, d double").groupBy("s").agg(*(F.sum(x).alias(x) for x in "abcd")).toPandas()
        return got.sort_values("s")[list("abcd")].to_numpy().T

    steps = np.zeros((0, 3, len(sources)))
    by_name, by_text, below, above = totals(steps)
    # each source's gradient is scaled by its supply, so one step size fits all; names and texts share it
    scale_name, scale_text = (np.where(live & (x > 0), 0.5 / np.maximum(x, 1e-9), 0.0) for x in (by_name, by_text))
    for _ in range(STEPS):
        if max(np.abs(by_name - goal)[live].max(), np.abs(by_text - goal)[live].max()) < 1e-9 * total:
            break
        name, text = (by_name - goal) * scale_name, (by_text - goal) * scale_text
        steps = np.concatenate([steps, [[name, name, text]]])
        by_name, by_text, below, above = totals(steps)
    # onto the totals by name: what lacks, over the documents that can still move, never goes too far
    for _ in range(STEPS):
        lack = goal - by_name
        free = np.where(lack > 0, below, above)
        name = np.where(live & (free > 0), -lack / np.maximum(free, 1.0), 0.0)
        if np.abs(name * free).max() < 1e-12 * total:
            break
        steps = np.concatenate([steps, [[name, np.zeros_like(name), np.zeros_like(name)]]])
        by_name, by_text, below, above = totals(steps)

    # whole copies: the fractions of each source go to the first documents in random order
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, _, p = columns_of(batch)
            rate = rates_of(own, p, steps, cap)
            whole = np.floor(rate + 1e-9)
            part = np.maximum(0.0, rate - whole)
            coin = (batch.column("draw").to_numpy().view(np.uint64) >> np.uint64(11)) / 2.0**53
            whole = np.where(own < 0, whole + (coin < part), whole)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in (id_column, "source", "tokens", "draw")), pa.array(whole.astype(np.int32)), pa.array(part), pa.array((coin - part + 1) / 2), pa.array(np.floor(cap[own]).astype(np.int32))], names=[id_column, "source", "tokens", "draw", "whole", "part", "place", "most"])

    rated = cut_lineage(table.mapInArrow(settle, f"`{id_column}` {kind}, source string, tokens bigint, draw bigint, whole int, part double, place double, most int"))
    bucket = F.least(F.floor(F.col("place") * ORDER_BUCKETS), F.lit(ORDER_BUCKETS - 1)).cast("int")
    may = F.col("whole") < F.col("most")
    placed = rated.where(F.col("source").isNotNull()).withColumn("bucket", bucket)
    hist = placed.groupBy("source", "bucket").agg(F.sum(F.when(may, F.col("tokens")).otherwise(0)).alias("tokens"), F.sum(F.col("part") * F.col("tokens")).alias("part")).toPandas()
    # tokens are whole, what the descent lacks is far below one
    plan = {s: float(np.round(x)) for s, x in hist.groupby("source")["part"].sum().items()}
    cuts = []
    for s, own in hist.sort_values("bucket").groupby("source"):
        run = own["tokens"].cumsum().to_numpy()
        k = int(np.searchsorted(run, plan[s], side="right"))
        before = float(run[k - 1]) if k else 0.0
        cuts.append((s, int(own["bucket"].iloc[k]) if k < len(own) else ORDER_BUCKETS, plan[s] - before))
    limits = spark.createDataFrame(cuts, "source string, cut int, left double")
    placed = placed.drop("part").join(F.broadcast(limits), "source")
    order = Window.partitionBy("source").orderBy("place", "draw", id_column)
    at_cut = may & (F.col("bucket") == F.col("cut"))
    # the bucket at the cut holds one part in ORDER_BUCKETS of the source
    edge = placed.where(at_cut).withColumn("run", F.sum("tokens").over(order)).withColumn("extra", F.col("run") <= F.col("left")).drop("run")
    placed = cut_lineage(placed.where(~at_cut).withColumn("extra", may & (F.col("bucket") < F.col("cut"))).unionByName(edge))
    placed = placed.withColumn("copies", F.col("whole") + F.col("extra").cast("int"))
    # what is left of each fraction goes to the largest documents that still fit and may have one more, one a round
    gaps = placed.groupBy("source").agg(F.sum(F.when(F.col("extra"), F.col("tokens")).otherwise(0)).alias("used")).toPandas()
    gap = {s: plan[s] - float(u) for s, u in zip(gaps["source"], gaps["used"])}
    chosen: list[tuple] = []
    for _ in range(FILL_ROUNDS):
        open_gaps = spark.createDataFrame([(s, g) for s, g in gap.items() if g >= 1] or [("", 0.0)], "source string, gap double")
        taken = spark.createDataFrame(chosen or [(None, -1)], T.StructType([table.schema[id_column], T.StructField("draw", T.LongType())]))
        free = placed.where(F.col("copies") < F.col("most")).join(F.broadcast(open_gaps), "source").where(F.col("tokens") <= F.col("gap")).join(F.broadcast(taken), [id_column, "draw"], "left_anti")
        best = free.groupBy("source").agg(F.max_by(F.struct(id_column, "draw", "tokens"), F.struct("tokens", "draw")).alias("b")).select("source", "b.*").toPandas()
        if best.empty:
            break
        for s, i, d, t in best[["source", id_column, "draw", "tokens"]].itertuples(index=False):
            chosen.append((i.item() if hasattr(i, "item") else i, int(d)))
            gap[s] -= float(t)
    if chosen:
        picked = spark.createDataFrame(chosen, T.StructType([table.schema[id_column], T.StructField("draw", T.LongType())])).withColumn("picked", F.lit(True)).distinct()
        placed = placed.join(F.broadcast(picked), [id_column, "draw"], "left").withColumn("copies", F.least(F.col("copies") + F.coalesce("picked", F.lit(False)).cast("int"), "most"))
    columns = [id_column, "source", "tokens", "copies"]
    out = placed.select(columns)
    if has_soft:
        out = out.unionByName(rated.where(F.col("source").isNull()).select(id_column, "source", "tokens", F.col("whole").alias("copies")))
    return out.where(F.col("copies") > 0)


def reached_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: its target and reached share of all tokens, tokens, documents and whether its cap binds."""
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    total = got.agg(F.sum("tokens").alias("total")).scalar()
    t = targets.select("source", "target_share", "max_repeats").dropDuplicates(["source"])
    return t.join(got, "source", "left").select(
        "source", "target_share", F.try_divide(F.coalesce("tokens", F.lit(0)), total).alias("share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats"
    )
