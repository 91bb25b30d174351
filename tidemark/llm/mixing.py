"""Mixing sources to target weights through a tree of budgets.

A budget of tokens goes down a tree (domain, language, source): the children of a node
share its budget by their weights.  A child gets no more than its documents can give in
``max_epochs`` passes; what it leaves goes to its siblings by their weights, and only
what none of them can take is missing higher up.  Because a node's limit is the sum of its
children's, filling from the root gives to siblings before ancestors.

A leaf passes over all its documents as often as its budget allows, and over the rest in
the seeded order of one more epoch: the documents whose running total of tokens stays
within what is left.  The order is cut into ranges by hash, so the running total needs
no task to hold a leaf: sums by range find the range in which the budget ends, and only
this one is put in order.

Defined results: a null in a path column is a value of its own; an unnamed value has
weight 1, and one with a weight of 0 or less gets nothing; a null text has no tokens;
documents with equal ids are taken in the order of their texts' hashes; repeated rows
count each and are taken or left together; an empty table gives an empty result; other
columns pass through, whatever their names.  A source whose number has more than 38 digits
has no domain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_folder

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
SALTS = 64
RANGE_DIGITS = 3  # hex digits of the order key: 4096 ranges a leaf

Weights = Mapping[str, Mapping[str, float]]


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _name(column: str) -> Column:
    return F.when(_col(column).isNull(), "n").otherwise(F.concat(F.lit("v"), _col(column).cast("string")))


def _weight(level: str, path: str, weights: Weights) -> Column:
    value = F.lit(1.0)
    for name, weight in weights.get(level, {}).items():
        value = F.when(F.col(path) == "v" + name, F.lit(float(weight))).otherwise(value)
    return F.greatest(value, F.lit(0.0))


def share(children: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """``given``: what each child gets of ``budget``, by ``weight``, up to ``limit``.

    In ascending order of limit by weight, a child is full if its limit is below its
    share of what the full ones before it leave; the first that is not full sets the
    rate for all others.
    """
    usable = F.col("weight") > 0
    order = Window.partitionBy(*parent).orderBy(F.when(usable, F.col("limit") / F.col("weight")).asc_nulls_first(), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    taken = F.when(usable, F.col("limit")).otherwise(0)
    rated = children.select(
        "*", (F.col("budget") - F.coalesce(F.sum(taken).over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("rest"))
    rated = rated.withColumn("rate", F.when(usable, F.col("left") / F.col("rest")))
    full = F.col("limit") <= F.col("rate") * F.col("weight")
    rate = F.max(F.when(~full, F.col("rate"))).over(whole)
    given = F.when(~usable, 0.0).when(full, F.col("limit").cast("double")).otherwise(rate * F.col("weight"))
    return rated.withColumn("given", given).drop("left", "rest", "rate")


def budgets(leaves: DataFrame, levels: Sequence[str], paths: Sequence[str], total: float, max_epochs: float, weights: Weights) -> DataFrame:
    """``quota`` of every leaf (paths, ``tokens``)."""
    given: DataFrame | None = None
    for depth, level in enumerate(levels):
        parent, here = list(paths[:depth]), list(paths[:depth + 1])
        nodes = leaves.groupBy(*here).agg(F.floor(F.sum("tokens") * F.lit(float(max_epochs))).alias("limit"))
        nodes = nodes.withColumn("weight", _weight(level, paths[depth], weights))
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(float(total)))
        else:
            nodes = nodes.join(given.select(*parent, F.col("given").alias("budget")), parent)
        given = share(nodes, parent, paths[depth]).select(*here, "given")
    return leaves.join(given.select(*paths, F.floor("given").alias("quota")), list(paths))


def ledger(docs: DataFrame, levels: Sequence[str] = LEVELS, total: float | None = None, max_epochs: float = 2.0,
           weights: Weights | None = None, seed: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """By row of ``docs``: id, levels, ``mix_text`` (hash), ``mix_tokens`` (words) and ``mix_copies``, how often the mixture holds it.

    ``total`` defaults to the tokens of all documents.  Texts are read once, to count
    their words; all else happens on this narrow table, written to the shared folder.
    """
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession)
    paths = [f"mix_{i}" for i in range(len(levels))]
    narrow = docs.select(
        _col(doc_id).alias("mix_id"), *(_col(c).alias(f"mix_level{i}") for i, c in enumerate(levels)), *(_name(c).alias(p) for p, c in zip(paths, levels)),
        F.xxhash64(_col(text)).alias("mix_text"), F.coalesce(F.regexp_count(_col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("mix_tokens"))
    narrow.withColumn("mix_salt", F.pmod(F.xxhash64("mix_id", "mix_text"), F.lit(SALTS))).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    rows.groupBy(*paths).agg(F.sum("mix_tokens").alias("tokens")).write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    if total is None:
        total = float(leaves.agg(F.sum("tokens")).first()[0] or 0)
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(0).cast("int")
    budgets(leaves, levels, paths, total, max_epochs, weights or {}).select(
        *paths, epochs.alias("mix_epochs"), (F.col("quota") - epochs * F.col("tokens")).alias("mix_rest")).write.parquet(f"{folder}/quotas")
    quotas = spark.read.parquet(f"{folder}/quotas")
    # a leaf may hold a third of all rows: it meets its quota under many salts
    salted = quotas.withColumn("mix_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("mix_epochs").cast("string"), F.coalesce(F.col("mix_id").cast("string"), F.lit(""))).cast("binary"))
    keyed = rows.join(salted, [*paths, "mix_salt"]).withColumn("mix_key", key).withColumn("mix_range", F.substring("mix_key", 1, RANGE_DIGITS))
    sums = keyed.groupBy(*paths, "mix_range").agg(F.sum("mix_tokens").alias("tokens"), F.first("mix_rest").alias("rest"))
    running = F.sum("tokens").over(Window.partitionBy(*paths).orderBy("mix_range"))
    # in a range that ends within the rest all are taken, in one that begins beyond it none
    ranges = sums.withColumn("after", running).select(
        *paths, "mix_range", (F.col("after") - F.col("tokens")).alias("mix_before"), (F.col("after") <= F.col("rest")).alias("mix_whole"))
    placed = keyed.join(ranges, [*paths, "mix_range"])
    within = Window.partitionBy(*paths, "mix_range").orderBy("mix_key", "mix_text").rangeBetween(Window.unboundedPreceding, 0)
    edge = ~F.col("mix_whole") & (F.col("mix_before") <= F.col("mix_rest"))
    ended = placed.where(edge).withColumn("mix_extra", F.col("mix_before") + F.sum("mix_tokens").over(within) <= F.col("mix_rest"))
    both = ended.unionByName(placed.where(~edge).withColumn("mix_extra", F.col("mix_whole")))
    # a leaf whose quota is a number of whole passes has nothing left for one more
    extra = (F.col("mix_extra") & (F.col("mix_rest") > 0)).cast("int")
    return both.select(F.col("mix_id").alias(doc_id), *(F.col(f"mix_level{i}").alias(c) for i, c in enumerate(levels)), "mix_text", "mix_tokens",
                       (F.col("mix_epochs") + extra).alias("mix_copies"))


def with_domain(docs: DataFrame, sources_per_domain: int = 5, source: str = "source") -> DataFrame:
    """``domain`` from the number in the source's name: neighbours belong together."""
    number = F.regexp_extract(_col(source), r"\d+", 0)
    return docs.withColumn("domain", F.when(number != "", F.concat(
        F.lit("domain"), F.floor(number.try_cast("decimal(38,0)") / sources_per_domain).cast("string"))))


def mixture(docs: DataFrame, domain: str | None = None, lang: str = "lang", source: str = "source", doc_id: str = "doc_id", text: str = "text",
            **settings) -> DataFrame:
    """The documents of the mixture, each as often as it holds them; same columns.

    ``domain`` names the column of the domains; without it they come from the sources' numbers.
    """
    key = {"doc_id": doc_id, "text": text, "lang": lang, "source": source} | ({"domain": domain} if domain else {})
    plain = docs.select(*(_col(c).alias(n) for n, c in key.items()))
    held = ledger(plain if domain else with_domain(plain), **settings).where("mix_copies > 0")
    levels = ("lang", "source", "domain") if domain else ("lang", "source")
    held = held.select(F.col("doc_id").alias("held_id"), *(F.col(c).alias(f"held_{c}") for c in levels), "mix_text", "mix_copies").distinct()
    # the documents under names of their own, so that none of theirs is met again
    given = docs.select(F.struct(*(_col(c).alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row"), _col(doc_id).alias("own_id"),
                        *(_col(key[c]).alias(f"own_{c}") for c in levels), F.xxhash64(_col(text)).alias("own_text"))
    same = F.col("own_id").eqNullSafe(F.col("held_id")) & (F.col("own_text") == F.col("mix_text"))
    for c in levels:
        same &= F.col(f"own_{c}").eqNullSafe(F.col(f"held_{c}"))
    copies = given.join(held, same).select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return copies.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
