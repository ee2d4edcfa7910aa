"""How filters interact: what each of them removes, alone and after others, in every order.

Every filter has a table of its own with the rows that fail it, stored once. A prefix is a set of filters applied
before. For all prefixes at once, the rows that fail a filter are listed under each prefix that does not hold it and
joined with the failing-id tables: left-anti against the prefix's filters gives what the filter removes after the
prefix, left-semi what the prefix had removed before it (redundant). Left-anti of all failing rows against a prefix's
filters gives the prefix's survivors; rows that fail nothing survive every prefix. An order of filters is a chain
of prefixes, so its steps only look up counts. All joins are on a row number that no two rows share, spread by hash,
and their inputs are shuffled once, without texts.

A row is a document of its own, also where an id is repeated. Null text counts as empty; a null part as the empty
string. Equal texts are found by their SHA-256 and the smallest id of it, joined on digest and id together, so that a
text that a third of all rows share is spread by id; a null id is neither smaller nor larger than others, so such
rows are no copies. A row has a label if any row of ``labels`` with its id has it; null ids have none. Very long texts
are handled row by row. Extra columns are not looked at. An empty table gives no parts, so no rows.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored

_BLANKS = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text of its own, by letter."""
    words = F.array_remove(F.split(text, _BLANKS), "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failing_rows(docs: DataFrame, part: str = "lang", copies: str = "E") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The judged rows (row, doc_id, part), and for each filter the stored table of the rows that fail it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    judged = stored(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), text.alias("text"))
        .select("row", "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                *(c.alias(letter) for letter, c in text_filters(F.col("text")).items())), "judged")
    failing = {letter: stored(judged.where(letter).select("row", "part"), f"failing-{letter}") for letter in "ABCD"}
    known = judged.where("doc_id IS NOT NULL").select("row", "part", "digest", "doc_id")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    failing[copies] = stored(known.join(first, ["digest", "doc_id"], "left_anti").select("row", "part"), f"failing-{copies}")
    return judged.select("row", "doc_id", "part"), failing


def _labelled(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """row, good, toxic of the rows that have either label."""
    marks = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .where("good = 1 OR toxic = 1"))
    return judged.where("doc_id IS NOT NULL").join(marks, "doc_id").select("row", F.coalesce("good", F.lit(0)).alias("good"),
                                                                          F.coalesce("toxic", F.lit(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    judged, failing = failing_rows(docs, part)
    letters = sorted(failing)
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    every = (1 << len(letters)) - 1
    prefixes = F.array(*(F.lit(p) for p in range(every + 1)))
    fails = reduce(DataFrame.unionByName, [rows.withColumn("filter", F.lit(bit[letter])) for letter, rows in failing.items()])
    by_row = fails.repartition("row")
    removers = by_row.select(F.col("row").alias("other"), F.col("filter").alias("remover"))
    hit = (F.col("row") == F.col("other")) & (F.col("prefix").bitwiseAND(F.col("remover")) != 0)

    # one candidate per failing row, filter and prefix without that filter
    outside = F.filter(prefixes, lambda p: p.bitwiseAND(F.col("filter")) == 0)
    labelled = by_row.join(_labelled(judged, labels), "row", "left").fillna(0, ["good", "toxic"])
    candidates = labelled.withColumn("prefix", F.explode(outside))
    removed = (candidates.join(removers, hit, "left_anti").groupBy("part", "filter", "prefix")
               .agg(F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")))
    redundant = (candidates.select("row", "part", "filter", "prefix").join(removers, hit, "left_semi")
                 .groupBy("part", "filter", "prefix").agg(F.count("*").alias("redundant")))
    failed = by_row.groupBy("row").agg(F.first("part").alias("part"))
    left = (failed.withColumn("prefix", F.explode(prefixes)).join(removers, hit, "left_anti")
            .groupBy("part", "prefix").agg(F.count("*").alias("left")))

    names = ["removed", "redundant", "good_lost", "toxic_lost", "left"]
    zero = lambda have: [F.lit(0).cast("long").alias(n) if n not in have else F.col(n).cast("long").alias(n) for n in names]
    cells = [removed.select("part", "filter", "prefix", *zero(["removed", "good_lost", "toxic_lost"])),
             redundant.select("part", "filter", "prefix", *zero(["redundant"])),
             left.select("part", F.lit(0).alias("filter"), "prefix", *zero(["left"]))]
    key = F.col("filter") * (every + 1) + F.col("prefix")
    counted = (reduce(DataFrame.unionByName, cells).groupBy("part", key.alias("key"))
               .agg(F.struct(*(F.sum(n).alias(n) for n in names)).alias("cell")))
    # a part has at most 6 x 32 cells
    tables = counted.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("key", "cell"))).alias("cells"))
    sizes = judged.groupBy("part").agg(F.count("*").alias("n"))
    passing = F.col("n") - F.coalesce(_cell(0, F.lit(0), every, "left"), F.lit(0))
    parts = sizes.join(tables, "part", "left").withColumn("passing", passing)
    steps = [{"filter_order": "".join(order), "step": i + 1, "filter": bit[letter], "prefix": sum(bit[x] for x in order[:i])}
             for order in permutations(letters) for i, letter in enumerate(order)]
    every_step = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,filter:int,prefix:int>>")
    lines = parts.withColumn("s", F.explode(every_step)).select("part", "passing", "cells", "s.*")
    return lines.select("part", "filter_order", "step", *_figures(letters, every))


def _cell(filter_, prefix: Column, every: int, name: str) -> Column:
    key = (F.lit(filter_) if isinstance(filter_, int) else filter_) * (every + 1) + prefix
    return F.coalesce(F.try_element_at(F.col("cells"), key)[name], F.lit(0).cast("long"))


def _figures(letters: list[str], every: int) -> list[Column]:
    own, prefix = F.col("filter"), F.col("prefix")
    alone = lambda p, name: _cell(own, p, every, name)
    n = len(letters)
    # how many of all orders have exactly these filters before the step
    orders = [factorial(bin(p).count("1")) * factorial(n - 1 - bin(p).count("1")) if p != every else 0 for p in range(every + 1)]
    shapley = reduce(lambda a, b: a + b, [alone(F.lit(p), "removed") * w for p, w in enumerate(orders) if w])
    return [
        (F.col("passing") + _cell(0, prefix.bitwiseOR(own), every, "left")).alias("kept"),
        alone(prefix, "removed").alias("removed"),
        alone(prefix, "redundant").alias("redundant"),
        alone(F.lit(every) - own, "removed").alias("unique_fails"),
        alone(prefix, "good_lost").alias("good_lost"),
        alone(prefix, "toxic_lost").alias("toxic_lost"),
        shapley.alias("shapley"),
    ]


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT row, doc_id, part, [
    len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
    coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)] AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT f.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN l USING (doc_id)),
o AS (
  SELECT [a, b, c, e, g] AS o, 'ABCDE'[a] || 'ABCDE'[b] || 'ABCDE'[c] || 'ABCDE'[e] || 'ABCDE'[g] AS filter_order
  FROM range(1, 6) t1(a), range(1, 6) t2(b), range(1, 6) t3(c), range(1, 6) t4(e), range(1, 6) t5(g)
  WHERE len(list_distinct([a, b, c, e, g])) = 5),
p AS (SELECT part, fails, good, toxic, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT part, filter_order, step, o[step] AS own, fails[o[step]] AS failing, good, toxic, n,
    list_bool_or(list_transform(o[1:step - 1], lambda x: fails[x])) AS before,
    len(list_filter(fails, lambda x: x)) = 1 AS sole
  FROM p, o, range(1, 6) r(step)),
c AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT coalesce(before, false) AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT coalesce(before, false) AND failing THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN coalesce(before, false) AND failing THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failing AND sole THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT coalesce(before, false) AND failing AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT coalesce(before, false) AND failing AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM c"""
