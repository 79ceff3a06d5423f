"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order. A document's virtual finish time is what
its source has sent up to and with it, divided by the source's target; serving all queues in order
of finish time keeps every source near its share at any moment. The order is cut at the budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.runs import running_total
from weftgraph.llm.store import free_name, numbered, store
from weftgraph.plans.sizing import broadcast_if_small

#: Text units that count as size.
WORD = r"[^\x20\x09-\x0D]+"
#: The weights given to the sources in turn.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and how often one document may be taken.
BUDGET_SHARE = 1.5
REPEATS = 2


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = BUDGET_SHARE) -> DataFrame:
    """``source, at, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, get the weights in turn and share ``share`` of all words;
    a target above ``REPEATS`` times the source's size is cut to that and the excess shared again
    by weight. Sorted by cap over weight, the sources that are cut come first, so
    the level all others share is read off running sums. The number of sources is not bounded.
    """
    keyed = store(
        sizes.select(
            "source", "source_size", F.col("source").isNull().cast("int").alias("none"), F.lit(1).cast("long").alias("one")
        ),
        "sources",
    )
    placed = running_total(keyed, None, ["none", "source"], ["one"], name="source-places")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("before_one") % len(weights)) + 1).cast("int"))
    weighed = store(
        placed.select(
            "source", "source_size", F.col("before_one").alias("at"), weight.cast("long").alias("weight"),
            (F.lit(REPEATS) * F.col("source_size")).cast("long").alias("cap"),
        ).withColumn("ratio", F.col("cap") / F.col("weight")),
        "source-weights",
    )
    summed = store(running_total(weighed, None, ["ratio", "at"], ["cap", "weight"], name="source-caps"), "source-sums")
    totals = summed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = share * (totals["size"] or 0)
    level = (F.lit(budget) - F.col("before_cap")) / (F.lit(totals["weight"] or 0) - F.col("before_weight"))
    shared = (
        summed.withColumn("level", level)
        .filter("level <= ratio")
        .agg(F.min(F.struct("ratio", "at", "level")).alias("first"))
        .first()["first"]
    )
    free = F.lit(shared["level"] if shared else 0.0)
    return summed.select(
        "source", "at", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * free).alias("target")
    )


def fair_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = BUDGET_SHARE, row_col: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, size, source_size, target, taken, copies``.

    ``size`` counts words (null text: 0), ``copies`` says how often the mix takes the document whole,
    0 to ``REPEATS``, ``taken`` is ``copies * size``. The shuffle is the MD5 of the id, then id and
    size, so reruns agree and rows that tie in all of it are alike. The queue of a source holds its
    documents once after the other, then again. A document whose end would pass the budget ends the
    mix. Documents without words and sources without words are never taken. An empty table gives
    no rows. A source may hold any part of the rows: its queue is cut into sorted slices.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    docs, row = numbered(docs, row_col)
    rows = docs.select(
        F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        words.alias("size"),
    )
    rows = store(rows.withColumn("turn", F.md5(F.col("doc_id").cast("string"))), "sizes")
    targets = store(
        source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share), "targets"
    )
    known = rows.join(broadcast_if_small(targets), rows["source"].eqNullSafe(targets["source"])).select(
        "row", "doc_id", "size", "turn", "at", "source_size", "target"
    )
    queued = store(
        running_total(known, "at", ["turn", "doc_id", "size"], ["size"], name="queues").drop("before_size", "turn"), "queued"
    )
    served = queued.filter("size > 0 AND target > 0")
    passes = [
        served.select(
            ((F.lit(i) * F.col("source_size") + F.col("upto_size")) / F.col("target")).alias("finish"),
            "at", F.lit(i).cast("long").alias("pass"), F.col("upto_size").alias("own"), "size",
        )
        for i in range(REPEATS)
    ]
    queue = passes[0]
    for more in passes[1:]:
        queue = queue.union(more)
    budget = share * (queued.agg(F.sum("size")).first()[0] or 0)
    sent = running_total(queue, None, ["finish", "at", "pass", "own"], ["size"], name="served")
    cut = (
        sent.filter(F.col("upto_size") <= budget)
        .agg(F.max(F.struct("finish", "at", "pass", "own")).alias("cut"))
        .first()["cut"]
    )
    copies = F.lit(0)
    if cut is not None:
        bound = F.struct(
            F.lit(cut["finish"]), F.lit(cut["at"]).cast("long"), F.lit(cut["pass"]).cast("long"),
            F.lit(cut["own"]).cast("long"),
        )
        for i in range(REPEATS):
            finish = (F.lit(i) * F.col("source_size") + F.col("upto_size")) / F.col("target")
            place = F.struct(finish, F.col("at"), F.lit(i).cast("long"), F.col("upto_size"))
            copies = copies + F.when((F.col("size") > 0) & (F.col("target") > 0) & (place <= bound), 1).otherwise(0)
    return queued.withColumn("copies", copies).select(
        "row", "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies"
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a document taken twice comes twice, one not taken is left out.

    All columns stay, whatever their names. Documents without words (null or blank text) are never
    taken; rows with equal ids are taken on their own; a table without rows stays empty; a null
    source is a source.
    """
    rows, row = numbered(docs)
    times = free_name(rows, "copies_")
    taken = fair_mix(rows, row_col=row, **options).filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(times))
    # Sorted on both sides at every size: as many rows as documents are no side to broadcast.
    joined = rows.join(taken.hint("merge"), row)
    again = free_name(joined, "again_")
    return joined.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(row, times, again)
