"""Mixing sources to target weights: budgets go down a tree of domains, languages and sources, and each leaf takes a
prefix of its tokens from seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.llm.common import ASCII_SPACE, table
from linkmill.session import written

#: Domains by the number at the end of a source's name, and integer weights of the production mix. A value that is not
#: listed has the weight under "".
DOMAIN_OF = {"web": range(0, 5), "news": range(5, 10), "books": range(10, 15), "forum": range(15, 20)}
DOMAIN_WEIGHTS = {"web": 45, "news": 20, "books": 20, "forum": 10, "": 5}
LANG_WEIGHTS = {"en": 60, "de": 15, "fr": 15, "es": 10, "": 5}
SOURCE_WEIGHTS = {"src0": 3, "": 1}
#: The budget as a percentage of all tokens, and how often a document may be taken at most.
BUDGET_PERCENT, EPOCHS = 100, 4
SEED = 42
#: Documents of a leaf are ordered by a digest. So many of its hex digits cut the order into ranges, and the range in
#: which the budget ends is cut again, on so many levels in all.
RANGE_DIGITS, RANGE_LEVELS = 2, 2


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(ASCII_SPACE.replace("[", "[^") + "+")).cast("long"), F.lit(0).cast("long"))


def domain(source: Column) -> Column:
    number = F.regexp_extract(source, r"^src([0-9]{1,9})$", 1)
    number = F.when(number != "", number.cast("int"))
    found = F.lit("other")
    for name, numbers in DOMAIN_OF.items():
        found = F.when(number.between(min(numbers), max(numbers)), name).otherwise(found)
    return found


def _weight(column: str, weights: dict[str, int]) -> Column:
    found = F.lit(weights[""])
    for name, weight in weights.items():
        if name:
            found = F.when(F.col(column) == name, weight).otherwise(found)
    return found.cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (``parent`` columns, ``name``, ``weight``, ``capacity``, and their parent's ``budget``) with ``share``.

    Children get their parent's budget in proportion to their weights, but none more than its capacity: what a child
    can't use goes to its siblings, in proportion again. A parent's budget never exceeds its children's capacity, so
    nothing is left. Whole tokens: what rounding leaves goes one by one to the unfilled children in order of name.
    """
    ranked = Window.partitionBy(*parent, "budget").orderBy(F.col("capacity").cast("double") / F.col("weight"), name)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    onwards = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    filled = (
        nodes.withColumn("left", F.col("budget") - F.coalesce(F.sum("capacity").over(before), zero))
        .withColumn("weights", F.sum("weight").over(onwards))
        # In this order the children that can't use their share come first.
        .withColumn("full", F.col("capacity") * F.col("weights") <= F.col("weight") * F.col("left"))
    )
    group = Window.partitionBy(*parent, "budget")
    rest = (
        filled.withColumn("open", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(zero)).over(group))
        .withColumn("open_weights", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(zero)).over(group))
        .withColumn("part", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("weight * open div open_weights")))
        .withColumn("over", F.col("budget") - F.sum("part").over(group))
        .withColumn("place", F.sum(F.when(~F.col("full"), 1).otherwise(0)).over(Window.partitionBy(*parent, "budget").orderBy(name)))
    )
    one_more = (~F.col("full") & (F.col("place") <= F.col("over"))).cast("long")
    return rest.withColumn("share", F.col("part") + one_more).drop(
        "left", "weights", "full", "open", "open_weights", "part", "over", "place"
    )


def leaf_budgets(leaves: DataFrame, budget_percent: int = BUDGET_PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """``leaves`` (``domain``, ``lang``, ``source``, ``tokens``) with ``budget``, shared out level by level.

    A subtree's capacity is all it can give in ``epochs`` passes. As each level knows the capacities below it, a
    shortage is met by siblings first, and only what a whole subtree can't give goes to its ancestors' siblings.
    """
    able = leaves.withColumn("capacity", F.col("tokens") * epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("all"))
    top = able.groupBy("domain").agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight("domain", DOMAIN_WEIGHTS))
    top = top.join(total.select(F.expr(f"least(all * {int(budget_percent)} div 100, all * {int(epochs)})").alias("budget")))
    by_domain = share_out(top, [], "domain").select("domain", F.col("share").alias("budget"))
    middle = able.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight("lang", LANG_WEIGHTS))
    by_lang = share_out(middle.join(by_domain, "domain"), ["domain"], "lang").select("domain", "lang", F.col("share").alias("budget"))
    low = able.withColumn("weight", _weight("source", SOURCE_WEIGHTS)).join(by_lang, ["domain", "lang"])
    return share_out(low, ["domain", "lang"], "source").select("domain", "lang", "source", "tokens", F.col("share").alias("budget"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    budget_percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as rows ``(doc_id, domain, lang, source, epoch, n_tokens, take_tokens)``, epochs counted from 1.

    ``docs`` has the id, the text, ``lang`` and ``source``. A leaf with a budget of b tokens and t tokens in all takes
    every document in b // t whole epochs, and of one more epoch, in its seeded order, the documents up to b % t
    tokens; the last one is cut to ``take_tokens``. So a leaf gives exactly its budget. Documents without words, null
    texts included, are never taken. A null language or source is a leaf of its own, named "". Repeated rows are
    taken each by itself; a null id is ordered first. Other columns are not read; an empty table gives no rows.

    Texts are read once and not shuffled. The order in a leaf is cut into 256 ranges by digest, and the one in which the
    budget ends into 256 again: whole ranges are taken by their sums, and only 1 in 65,536 documents of a leaf is
    sorted, so a leaf with a third of all documents is no single task.
    """
    rows = written(
        docs.select(
            F.col(f"`{doc_id}`").alias("id"),
            F.coalesce("lang", F.lit("")).alias("lang"),
            F.coalesce("source", F.lit("")).alias("source"),
            word_count(F.col(f"`{text}`")).alias("n_tokens"),
        )
        .where("n_tokens > 0")
        .withColumn("domain", domain(F.col("source"))),
        "mix-rows",
    )
    leaf = ["domain", "lang", "source"]
    leaves = rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"))
    plan = written(
        leaf_budgets(leaves, budget_percent, epochs)
        .withColumn("whole", F.expr("budget div tokens"))
        .withColumn("rest", F.expr("budget % tokens")),
        "mix-plan",
    )
    placed = rows.join(plan.select(*leaf, "whole", "rest"), leaf).withColumn(
        "draw",
        F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"), F.col("id").cast("string")).cast("binary")),
    )
    zero = F.lit(0).cast("long")
    # The range in which the budget ends, and the tokens before it; each level cuts the last one's range again.
    cuts = plan.where("rest > 0").select(*leaf, F.lit("").alias("cut"), zero.alias("before"))
    upto = Window.partitionBy(*leaf).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    for digits in range(RANGE_DIGITS, RANGE_DIGITS * RANGE_LEVELS + 1, RANGE_DIGITS):
        reached = placed.join(cuts, leaf).where(F.col("draw").startswith(F.col("cut")))
        sums = reached.groupBy(*leaf, "rest", "before", F.substring("draw", 1, digits).alias("range")).agg(F.sum("n_tokens").alias("in_range"))
        ranges = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("in_range").over(upto), zero))
        last_range = F.max(F.struct("range", "before")).alias("last")
        cuts = written(
            ranges.where("before < rest").groupBy(*leaf).agg(last_range).select(
                *leaf, F.col("last.range").alias("cut"), F.col("last.before").alias("before")
            ),
            "mix-cuts",
        )
    cut = placed.join(cuts, leaf)
    inside = cut.where(F.col("draw").startswith(F.col("cut")))
    order = Window.partitionBy(*leaf).orderBy("draw", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        inside.withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(order), zero))
        .where("start < rest")
        .withColumn("take_tokens", F.least("n_tokens", F.col("rest") - F.col("start")))
    )
    names = [F.col("id").alias(doc_id), *leaf]
    whole = placed.where("whole > 0").select(
        *names, F.explode(F.sequence(F.lit(1).cast("long"), "whole")).alias("epoch"), "n_tokens", F.col("n_tokens").alias("take_tokens")
    )
    partly = cut.where(F.substring("draw", 1, RANGE_DIGITS * RANGE_LEVELS) < F.col("cut")).select(*names, (F.col("whole") + 1).alias("epoch"), "n_tokens", F.col("n_tokens").alias("take_tokens"))
    return whole.unionByName(partly).unionByName(last.select(*names, (F.col("whole") + 1).alias("epoch"), "n_tokens", "take_tokens"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def _cases(column: str, weights: dict[str, int]) -> str:
    return f"case {' '.join(f"when {column} = '{k}' then {v}" for k, v in weights.items() if k)} else {weights['']} end"


def _level(name: str, nodes: str, parent: str, child: str) -> str:
    """Water-filling in SQL: the largest level at which no child takes more than it has, found by trying each child."""
    on = f"using ({parent})" if parent else "on true"
    group = f"group by {parent}" if parent else ""
    key = f"{parent}, " if parent else ""
    over = f"partition by {parent}" if parent else ""
    both = " and ".join(f"a.{c} = b.{c}" for c in parent.split(", ")) if parent else "true"
    return f"""
{name}_try as (select a.*, a.budget - coalesce((select sum(capacity) from {nodes} b where {both} and (b.capacity::double / b.weight, b.{child}) < (a.capacity::double / a.weight, a.{child})), 0) remaining,
  (select sum(weight) from {nodes} b where {both} and (b.capacity::double / b.weight, b.{child}) >= (a.capacity::double / a.weight, a.{child})) weights from {nodes} a),
{name}_full as (select *, capacity * weights <= weight * remaining filled from {name}_try),
{name}_open as (select {key}any_value(budget) - coalesce(sum(capacity) filter (filled), 0) open_budget, sum(weight) filter (not filled) open_weight from {name}_full {group}),
{name}_part as (select f.*, case when filled then capacity else (weight * open_budget) // open_weight end part from {name}_full f join {name}_open {on}),
{name} as (select * exclude (part), part + case when not filled and sum(case when filled then 0 else 1 end) over ({over} order by {child}) <= budget - sum(part) over ({over}) then 1 else 0 end share from {name}_part)"""


def oracle(documents: str = "documents") -> str:
    number = "try_cast(nullif(regexp_extract(source, '^src([0-9]{1,9})$', 1), '') as int)"
    domains = " ".join(f"when {number} between {min(r)} and {max(r)} then '{d}'" for d, r in DOMAIN_OF.items())
    return f"""
with named as (select doc_id, coalesce(lang, '') lang, coalesce(source, '') source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens from {documents}),
d as (select *, case {domains} else 'other' end as domain from named where n_tokens > 0),
leaves as (select domain, lang, source, sum(n_tokens)::bigint tokens, sum(n_tokens)::bigint * {EPOCHS} capacity from d group by all),
tops as (select domain, sum(capacity)::bigint capacity, {_cases('domain', DOMAIN_WEIGHTS)} weight, (select least(sum(tokens) * {BUDGET_PERCENT} // 100, sum(tokens) * {EPOCHS}) from leaves)::bigint budget from leaves group by domain),
{_level('top', 'tops', '', 'domain')},
mids as (select domain, lang, sum(l.capacity)::bigint capacity, {_cases('lang', LANG_WEIGHTS)} weight, any_value(share)::bigint budget from leaves l join top using (domain) group by domain, lang),
{_level('mid', 'mids', 'domain', 'lang')},
lows as (select l.*, {_cases('source', SOURCE_WEIGHTS)} weight, share::bigint budget from leaves l join mid using (domain, lang)),
{_level('low', 'lows', 'domain, lang', 'source')},
plan as (select domain, lang, source, tokens, share::bigint // tokens as whole, share::bigint % tokens as rest from low),
drawn as (select doc_id, domain, lang, source, n_tokens, whole, rest, md5('{SEED}:' || (whole + 1) || coalesce(':' || doc_id, '')) draw from d join plan using (domain, lang, source)),
run as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by draw, doc_id nulls first, n_tokens rows between unbounded preceding and 1 preceding), 0) start from drawn)
select doc_id, domain, lang, source, unnest(range(1, whole + 1))::bigint epoch, n_tokens, n_tokens take_tokens from drawn
union all
select doc_id, domain, lang, source, (whole + 1)::bigint epoch, n_tokens, least(n_tokens, rest - start)::bigint take_tokens from run where start < rest
"""


ORACLE = oracle()
