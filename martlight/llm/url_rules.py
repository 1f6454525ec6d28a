"""URL filter: given rules first, then association rules mined with FP-growth.

Given rules (host and path prefix) judge the urls they fit; the longest fitting rule
wins.  These judged urls are the labels: each is a transaction of its tokens (scheme,
host endings, first path segment, file ending, query keys, fragment) and its verdict.
Spark's FP-growth mines token combinations; rules that lead to a verdict are kept if
their support and confidence suffice and no rule with one token less is as sure.

The other urls are matched through an inverted index: token -> rules that need it.  A
rule matches if all its tokens hit; the surest match decides (then the longer, the more
frequent, the rule's text).  Without a match the verdict is ``DEFAULT``.

Everything is DataFrame, SQL and Spark ML.  A token that most urls share makes a large
join key; the index side is a written table whose size decides the join, and adaptive
execution splits the other side.

Defined results: a null url, or one without ``://``, has empty host and path and gets
the method's verdict; repeated rows are judged row by row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import lower_ascii, pick, written

# The contract's rules, verdict by host and path prefix.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow")]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
_VERDICT = "verdict="


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end; then up to
    ``?``, ``#`` or the end."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.char_length(u))).otherwise(F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def given_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url; numbers and free text are left out."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda k: k != ""),
                       lambda k: F.concat(F.lit("query="), F.substring_index(k, "=", 1)))
    first = F.regexp_extract(path, r"^/([A-Za-z][A-Za-z_-]*)(?:/|$)", 1)
    ending = lower_ascii(F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1))

    def given(ok: Column, value: Column) -> Column:
        return F.when(ok, F.array(value)).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(
        given(F.instr(F.coalesce(url, F.lit("")), "://") > 0,
              F.concat(F.lit("scheme="), lower_ascii(F.substring_index(url, "://", 1)))),
        given(host != "", F.concat(F.lit("top="), F.element_at(labels, -1))),
        given(n > 1, F.concat(F.lit("site="), F.substring_index(host, ".", -2))),
        given(n > 2, F.concat(F.lit("first="), F.element_at(labels, 1))),
        given(n > 3, F.concat(F.lit("second="), F.element_at(labels, 2))),
        given(first != "", F.concat(F.lit("path="), first)),
        given(ending != "", F.concat(F.lit("ending="), ending)),
        given(path.endswith("/"), F.lit("folder")),
        given(F.instr(F.coalesce(url, F.lit("")), "#") > 0, F.lit("fragment")),
        keys))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule, verdict, confidence, support, items of the kept association rules of
    ``labelled`` (tokens, verdict)."""
    from pyspark.ml.fpm import FPGrowth
    spark = labelled.sparkSession
    kept_schema = "rule string, verdict string, confidence double, support double, items array<string>"
    transactions = written(labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit(_VERDICT), "verdict"))).alias("items")), "url-labelled")
    if transactions.isEmpty():
        return spark.createDataFrame([], kept_schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(transactions)
    rules = written(
        model.associationRules
        .where(F.element_at("consequent", 1).startswith(_VERDICT)
               & ~F.exists("antecedent", lambda t: t.startswith(_VERDICT)))
        .select(F.array_sort("antecedent").alias("items"),
                F.substring_index(F.element_at("consequent", 1), _VERDICT, -1).alias("verdict"),
                "confidence", "support")
        .withColumn("rule", F.array_join("items", " & ")), "url-rules")
    # dropped if a rule with one token less is at least as sure of the same verdict
    shorter = (rules.where(F.size("items") > 1)
               .select("rule", "verdict", "confidence", F.explode("items").alias("out"), "items")
               .select("rule", "verdict", "confidence",
                       F.array_join(F.array_remove("items", F.col("out")), " & ").alias("less")))
    known = rules.select(F.col("rule").alias("less"), "verdict", F.col("confidence").alias("sure"))
    needless = (shorter.join(known, ["less", "verdict"]).where("sure >= confidence")
                .select("rule", "verdict").distinct())
    return rules.join(needless, ["rule", "verdict"], "left_anti").select(
        "rule", "verdict", "confidence", "support", "items")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence of every row."""
    rows = pick(pages, ["page_id", "url"], "pages")
    host, path = parts(F.col("url"))
    rows = (rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url",
                        host.alias("host"), path.alias("path"))
            .withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
            .select("row", "page_id", "host", "path", F.col("given.rule").alias("rule"),
                    F.col("given.verdict").alias("verdict"),
                    tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")))
    rows = written(rows, "url-rows")
    mined = written(mine(rows.where("rule is not null").select("tokens", "verdict")), "url-mined")
    # inverted index: one row per token of a rule
    index = written(mined.select(F.explode("items").alias("token"), F.size("items").alias("needs"), F.struct(
        "confidence", F.size("items").alias("length"), "support", "rule",
        F.col("verdict").alias("says")).alias("found")), "url-index")
    open_rows = rows.where("rule is null").select("row", F.explode("tokens").alias("token"))
    surest = (open_rows.join(index, "token").groupBy("row", "found", "needs")
              .agg(F.count(F.lit(1)).alias("got")).where("got = needs")
              .groupBy("row").agg(F.max("found").alias("found")))
    return (rows.join(surest, "row", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", "found.says", F.lit(DEFAULT)).alias("verdict"),
                    F.col("found.rule").alias("mined_rule"), F.col("found.confidence").alias("confidence")))
