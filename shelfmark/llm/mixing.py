"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

A token budget runs down a tree of domains, their languages and their sources. A node's budget is shared among its
children by weight; a child gets no more than its leaves can give (their tokens times ``EPOCHS``), and what it lacks goes
to its siblings by weight. Only what a whole family lacks is short one level up, where that family in turn was
capped. Shares are whole tokens, rounded down.

A leaf's budget is read from seeded epochs: as many whole passes over its documents as fit, then a prefix of one more
pass in an order that the seed, the number of the pass and the id give. The prefix ends before the document that would
exceed the budget; documents that tie in that order are in or out together.

The leaf's order is cut into ``BUCKETS`` ranges whose tokens are summed before the shuffle, so only the rows of the one
range in which the budget ends are put in order, and a leaf with a third of all rows is nobody's single task. Documents
themselves stay where they are: the tree with its cut points is joined to them (broadcast if its counted rows are few).

Nulls and edges: a null lang or source is a leaf named 'none'; a null text has no tokens and is in with every pass of
its leaf; a row without doc_id is ordered by its text; an empty table gives an empty result; a weight of 0 gives
nothing; a text of any length is counted where it stands, as its number of words only; a name that isn't listed has the weight listed for None, 0 without it; other columns are not read, and pass through the mixture as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm._session import table, written

EPOCHS, SEED = 2, 17
#: Of all tokens, the part that is wanted.
PERCENT = 50
BUCKETS_HEX = 3  # 16 ** 3 ranges
BROADCAST_ROWS = 50_000

#: Production weights: domains, then languages within each; sources within a language weigh the same.
DOMAINS = {"web": 40, "books": 30, "code": 10, "news": 20}
LANGS = {"en": 60, "de": 15, "fr": 15, "es": 10}
#: A source's domain, by its number modulo four.
DOMAIN_OF = ("web", "books", "code", "news")
#: Those of the names that aren't listed: each has this weight beside its listed siblings.
UNLISTED = {None: 1}
TREE = ("domain", "lang", "source")


def domain_of(source: Column) -> Column:
    number = F.regexp_extract(source, r"([0-9]+)$", 1)
    out = F.lit("none")
    for i, name in enumerate(DOMAIN_OF):
        out = F.when((number != "") & (F.pmod(number.cast("decimal(38,0)"), F.lit(len(DOMAIN_OF)).cast("decimal(38,0)")) == i), name).otherwise(out)
    return out


def weight_of(name: Column, weights: Mapping[str | None, int] | None) -> Column:
    if weights is None:
        return F.lit(1).cast("long")
    out = F.lit(int(weights.get(None, 0))).cast("long")
    for key, value in ((k, v) for k, v in weights.items() if k is not None):
        out = F.when(name == key, F.lit(int(value)).cast("long")).otherwise(out)
    return out


def leaves_of(docs: DataFrame) -> DataFrame:
    """Adds _domain, _lang, _source, _tokens and _key (what orders a document among its leaf's)."""
    source, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.withColumns({"_domain": domain_of(source), "_lang": lang, "_source": source, "_tokens": tokens, "_key": key})


def shared_out(children: DataFrame, family: list[str]) -> DataFrame:
    """Adds budget to (family.., cap, weight, given): given is the family's budget, shared by weight up to the caps.

    Children are capped in the order of cap / weight: one is, if its share of what is left exceeds its cap.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    ordered = Window.partitionBy(*family).orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), "name")
    before, after = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*family)
    ranked = children.withColumn("left", F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("rest", F.sum("weight").over(after))
    full = ranked.withColumn("full", (F.col("weight") > 0) & (wide(F.col("cap")) * wide(F.col("rest")) <= wide(F.col("weight")) * wide(F.col("left"))))
    open_left = F.col("given") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(whole)
    shared = full.withColumn("open_left", open_left).withColumn("open_weight", open_weight)
    part = F.expr("(cast(weight as decimal(19,0)) * cast(open_left as decimal(19,0))) div cast(open_weight as decimal(19,0))").cast("long")
    budget = F.when(F.col("full"), F.col("cap")).when((F.col("weight") > 0) & (F.col("open_weight") > 0), F.least("cap", part)).otherwise(F.lit(0).cast("long"))
    return shared.withColumn("budget", budget).drop("left", "rest", "full", "open_left", "open_weight")


def budgets(leaves: DataFrame, percent: int, epochs: int, weights: tuple[Mapping[str, int] | None, ...]) -> DataFrame:
    """domain, lang, source, tokens, budget of (domain, lang, source, tokens)."""
    caps = leaves.withColumn("cap", F.col("tokens") * epochs)
    given = leaves.agg(F.sum("tokens").alias("t")).select(F.expr(f"coalesce(cast(t * {percent} as bigint) div 100, 0)").alias("given"))
    usable = lambda depth: caps.withColumn("ok", F.least(F.lit(1), F.lit(1), *(F.sign(weight_of(F.col(TREE[i]), weights[i])) for i in range(depth, 3))))
    level = None
    for depth, column in enumerate(TREE):
        path = list(TREE[: depth + 1])
        # What a node can give: leaves that some weight below it keeps out don't count.
        nodes = usable(depth + 1).groupBy(*path).agg(F.sum(F.col("cap") * F.col("ok").cast("long")).alias("cap"))
        nodes = nodes.withColumn("weight", weight_of(F.col(column), weights[depth])).withColumn("name", F.col(column))
        if level is None:
            nodes = nodes.withColumn("_root", F.lit(0)).join(given.withColumn("_root", F.lit(0)), "_root")
            level = shared_out(nodes, ["_root"]).select(*path, F.col("budget").alias("given"))
        else:
            level = shared_out(nodes.join(level, path[:-1]), path[:-1]).select(*path, F.col("budget").alias("given"))
    return leaves.join(level.withColumnRenamed("given", "budget"), list(TREE))


def order_of(key: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key).cast("binary"))


def plan(docs: DataFrame, percent: int, epochs: int, seed: int, weights: tuple[Mapping[str, int] | None, ...]) -> DataFrame:
    """For each leaf: its whole passes, and the last place of the prefix of one more (null if it is empty)."""
    keyed = written(leaves_of(docs.select("doc_id", "text", "lang", "source")).select(F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("_tokens").alias("n"), F.col("_key").alias("key")), "mix-keys")
    leaves = keyed.groupBy(*TREE).agg(F.sum("n").alias("tokens"))
    leaf = written(
        budgets(leaves, percent, epochs, weights)
        .withColumn("passes", F.expr("case when tokens > 0 then budget div tokens else 0 end"))
        .withColumn("rest", F.expr("budget - passes * tokens")),
        "mix-leaves",
    )
    few = leaf.count() <= BROADCAST_ROWS
    held = F.broadcast(leaf) if few else leaf
    placed = keyed.join(held, list(TREE)).withColumn("at", order_of(F.col("key"), F.col("passes"), seed)).withColumn("bucket", F.substring("at", 1, BUCKETS_HEX))
    sums = placed.groupBy(*TREE, "bucket", "rest").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*TREE).orderBy("bucket")
    marked = sums.withColumn("upto", F.sum("n").over(up_to)).withColumn("before", F.col("upto") - F.col("n"))
    # The range in which the budget ends; those before it are in as a whole.
    ends = marked.filter("upto > rest and before <= rest").groupBy(*TREE).agg(F.min(F.struct("bucket", "before")).alias("end"))
    whole = marked.filter("upto <= rest").groupBy(*TREE).agg(F.max("bucket").alias("whole"))
    last = placed.join(F.broadcast(ends) if few else ends, list(TREE)).filter(F.col("bucket") == F.col("end.bucket"))
    last = last.withColumn("upto", F.col("end.before") + F.sum("n").over(Window.partitionBy(*TREE).orderBy("at")))
    part = last.filter("upto <= rest").groupBy(*TREE).agg(F.max("at").alias("part"))
    found = leaf.join(whole, list(TREE), "left").join(part, list(TREE), "left")
    return written(found.select(*TREE, "passes", F.coalesce(F.col("part"), F.concat("whole", F.lit("g"))).alias("last")), "mix-plan")


def mix(
    docs: DataFrame, percent: int = PERCENT, epochs: int = EPOCHS, seed: int = SEED, weights: tuple[Mapping[str, int] | None, ...] = (DOMAINS | UNLISTED, LANGS | UNLISTED, None)
) -> DataFrame:
    """The chosen documents, with their columns and domain, n_tokens and epochs (in how many passes each is read)."""
    cuts = plan(docs, percent, epochs, seed, weights).select(*(F.col(c).alias(f"_{c}") for c in (*TREE, "passes", "last")))
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "doc_id", "text", "lang", "source")  # apart from our columns
    joined = leaves_of(own).join(cuts, [f"_{c}" for c in TREE])
    inside = F.coalesce(order_of(F.col("_key"), F.col("_passes"), seed) <= F.col("_last"), F.lit(False))
    times = (F.col("_passes") + inside.cast("long")).cast("int")
    out = joined.withColumn("_times", times).filter("_times > 0")
    kept = [c for c in docs.columns if c not in ("domain", "n_tokens", "epochs")]
    return out.select(*(F.col("_row").getField(c).alias(c) for c in kept), F.col("_domain").alias("domain"), F.col("_tokens").alias("n_tokens"), F.col("_times").alias("epochs"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens", "epochs")


def _weights(name: str, weights: Mapping[str, int]) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {UNLISTED[None]} END"


def _level(nodes: str, family: str, out: str) -> str:
    order = f"PARTITION BY {family} ORDER BY CASE WHEN weight > 0 THEN cap / weight END NULLS LAST, name"
    return f"""
{out}_a AS (SELECT *, given - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rst FROM {nodes}),
{out}_b AS (SELECT *, weight > 0 AND cap::HUGEINT * rst <= weight::HUGEINT * lft AS ful FROM {out}_a),
{out}_c AS (SELECT *, given - sum(CASE WHEN ful THEN cap ELSE 0 END) OVER (PARTITION BY {family}) AS ol,
  sum(CASE WHEN ful THEN 0 ELSE weight END) OVER (PARTITION BY {family}) AS ow FROM {out}_b),
{out} AS (SELECT *, CASE WHEN ful THEN cap WHEN weight > 0 AND ow > 0 THEN least(cap, (weight::HUGEINT * ol::HUGEINT) // ow::HUGEINT) ELSE 0 END AS budget FROM {out}_c)"""


def oracle() -> str:
    names = " ".join(f"WHEN n4 = {i} THEN '{x}'" for i, x in enumerate(DOMAIN_OF))
    d, g = _weights("domain", DOMAINS), _weights("lang", LANGS)
    return rf"""
WITH d0 AS (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, lang AS l0, source AS s0,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS key FROM documents),
d1 AS (SELECT *, try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS HUGEINT) % 4 AS n4 FROM d0),
d AS (SELECT *, CASE {names} ELSE 'none' END AS domain FROM d1),
leaf AS (SELECT domain, lang, source, sum(n)::BIGINT AS tokens, sum(n)::BIGINT * {EPOCHS} AS cap FROM d GROUP BY ALL),
n1 AS (SELECT 0 AS root, domain, domain AS name, {d} AS weight, sum(CASE WHEN {g} > 0 THEN cap ELSE 0 END) AS cap,
  (SELECT coalesce(sum(tokens) * {PERCENT} // 100, 0) FROM leaf) AS given FROM leaf GROUP BY domain),
{_level("n1", "root", "b1")},
n2 AS (SELECT leaf.domain, lang, lang AS name, {g} AS weight, sum(leaf.cap) AS cap, any_value(b1.budget) AS given
  FROM leaf JOIN b1 ON leaf.domain = b1.domain GROUP BY leaf.domain, lang),
{_level("n2", "domain", "b2")},
n3 AS (SELECT leaf.domain, leaf.lang, source, source AS name, 1 AS weight, leaf.cap, leaf.tokens, b2.budget AS given
  FROM leaf JOIN b2 ON leaf.domain = b2.domain AND leaf.lang = b2.lang),
{_level("n3", "domain, lang", "b3")},
p AS (SELECT d.*, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS passes, budget, tokens FROM d JOIN b3 USING (domain, lang, source)),
q AS (SELECT *, budget - passes * tokens AS rest, md5('{SEED}:' || passes::BIGINT::VARCHAR || ':' || key) AS ord FROM p),
r AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY ord) <= rest AS inside FROM q)
SELECT doc_id, domain, l0 AS lang, s0 AS source, n AS n_tokens, (passes + inside::INT)::INT AS epochs FROM r WHERE passes + inside::INT > 0
"""
