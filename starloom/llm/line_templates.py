"""Line de-duplication by a log-template tree.  DataFrame functions only.

A line's tokens are its words split on ASCII white space; tokens with a digit
are variable from the start (``<*>``).  The tree has a fixed depth: token count,
then the first ``LEAD`` tokens.  At a leaf, a token stays in the template if it
stands at its place in ``min_docs`` lines of the leaf or more, and becomes
``<*>`` otherwise; lines of which less than ``min_constant`` of the tokens stay
are no template.  A template recurs if ``min_docs`` documents or more, of
``min_shapes`` different numbers of lines or more, have it, and then all its
lines are dropped.  Numbers of lines tell documents that share a line from
copies of one document, which are left to document de-duplication.

Lines of fewer than ``min_tokens`` tokens are never dropped.  NULL texts stay
NULL and have no lines; a text without recurring lines stays as it is; one of
nothing else becomes empty, and its row stays.  Documents are told apart by id
and text, so repeated rows count once and lose the same lines.  Lines end at
"\\n".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh, staged

LEAD, MIN_TOKENS = 3, 4
MIN_DOCS, MIN_SHAPES, MIN_CONSTANT = 5, 3, 0.6
ANY = "<*>"
#: Bits of the filter that thins rows ahead of a join: 64 KB, whatever the number of keys.
FILTER_BITS = 1 << 19


def maybe_in(keys: DataFrame, col: str):
    """A test ``Column -> Column`` that holds for every value of ``col`` in
    ``keys`` and few others: a bitmap of fixed size as a binary literal, so
    what reaches the driver and the tasks is bounded."""
    slot = keys.select(F.pmod(F.xxhash64(col), F.lit(FILTER_BITS)).alias("s"))
    rows = slot.groupBy(F.shiftright("s", 3).alias("at")) \
        .agg(F.bit_or(F.expr("shiftleft(1, cast(s % 8 as int))")).alias("bits")).collect()
    bitmap = bytearray(FILTER_BITS // 8)
    for r in rows:
        bitmap[r["at"]] = r["bits"]
    literal = F.lit(bitmap)

    def test(c: Column) -> Column:
        s = F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
        byte = F.conv(F.hex(F.substring(literal, (F.shiftright(s, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.pmod(F.floor(byte / F.pow(F.lit(2.0), s % 8)), F.lit(2)) == 1

    return test


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), ANY).otherwise(t))


def _blanks(text: Column) -> Column:
    """ASCII white space other than "\\n" as blanks: tokens then lie between
    blanks, where a split needs no regex engine."""
    for c in "\t\x0b\f\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _tokens(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _lines(docs: DataFrame, text: Column, key: Column, min_tokens: int) -> DataFrame:
    """One row per line with enough tokens: key, n_lines, pos, line (white
    space as blanks), n, leaf."""
    # outer: a test for empty arrays would be put ahead and split each text again
    lines = docs.select(key.alias("key"), F.split(_blanks(text), "\n", -1).alias("all")) \
        .select("key", F.size("all").alias("n_lines"), F.posexplode_outer("all").alias("pos", "line")) \
        .withColumn("tokens", _tokens(F.col("line")))
    lead = [F.get("tokens", F.lit(i)) for i in range(LEAD)]
    n = F.size("tokens")
    leaf = F.xxhash64(n, *[F.when(t.rlike("[0-9]"), ANY).otherwise(t) for t in lead])
    # generated, so that filters on them don't make the tokens once more
    return lines.select("key", "n_lines", "pos", "line", F.inline(F.array(F.struct(n.alias("n"), leaf.alias("leaf"))))) \
        .filter(F.col("n") >= min_tokens)


def recurring_lines(docs: DataFrame, text: Column, key: Column, min_docs: int = MIN_DOCS, min_shapes: int = MIN_SHAPES,
                    min_constant: float = MIN_CONSTANT, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(key, dropped): places of the lines to drop, for every key with any."""
    lines = _lines(docs, text, key, min_tokens)
    # leaves that may hold a recurring template; combined before the shuffle, so a hot leaf costs a row a task
    leaves = staged(lines.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("lines"), F.min("n_lines").alias("lo"), F.max("n_lines").alias("hi"))
        .filter((F.col("lines") >= min_docs) & ((F.col("lo") < F.col("hi")) | (F.lit(min_shapes) <= 1))).select("leaf"), "leaves")
    found = lines.filter(maybe_in(leaves, "leaf")(F.col("leaf"))).join(leaves, "leaf")
    tokens = _masked(_tokens(F.col("line")))
    # equal lines of a leaf have one template: it is made once
    found = staged(found.select("leaf", "key", "n_lines", "pos", tokens.alias("tokens"))
                   .withColumn("form", F.xxhash64("leaf", "tokens")), "leaf-lines")
    forms = found.groupBy("leaf", "form").agg(F.count(F.lit(1)).alias("lines"), F.any_value("tokens").alias("tokens"))
    places = staged(forms.select("leaf", "form", "lines", F.posexplode("tokens").alias("at", "token")), "places")
    often = places.groupBy("leaf", "at", "token").agg(F.sum("lines").alias("lines")) \
        .filter((F.col("lines") >= min_docs) & (F.col("token") != ANY)).drop("lines")
    parts = places.join(often.withColumn("stays", F.lit(True)), ["leaf", "at", "token"], "left")
    stays = F.coalesce("stays", F.lit(False))
    templates = parts.groupBy("leaf", "form").agg(
        F.array_sort(F.collect_list(F.struct("at", F.when(stays, F.col("token")).otherwise(F.lit(ANY)).alias("t")))).alias("t"),
        F.avg(stays.cast("int")).alias("constant")).filter(F.col("constant") >= min_constant) \
        .select("leaf", "form", F.xxhash64("leaf", F.col("t.t")).alias("template"))
    made = staged(found.select("leaf", "form", "key", "n_lines", "pos").join(templates, ["leaf", "form"]), "templates")
    support = made.select("template", "key", "n_lines").distinct().groupBy("template", "n_lines") \
        .agg(F.count(F.lit(1)).alias("docs")).groupBy("template") \
        .agg(F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("shapes")) \
        .filter((F.col("docs") >= min_docs) & (F.col("shapes") >= min_shapes)).select("template")
    # places of one document: as many as it has lines at most
    return made.join(support, "template").groupBy("key").agg(F.collect_set("pos").alias("dropped"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with recurring lines dropped from the text, and the numbers of
    lines before and dropped as a struct column ``lines`` (n_lines, n_dropped)
    that replaces a column of that name."""
    k, hit = fresh(docs, "_key"), fresh(docs, "_hit")
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.col(id_col).cast("string"), text)
    drops = staged(recurring_lines(docs, text, key, **limits).withColumnRenamed("key", k), "drops")
    flagged = docs.withColumn(k, key).withColumn(hit, maybe_in(drops, k)(F.col(k)))
    dropped = fresh(docs, "dropped")
    drops = drops.withColumnRenamed("dropped", dropped) if dropped != "dropped" else drops
    # only documents that may lose lines are shuffled to meet what they lose
    # (in a hash join on the drops whatever their number, so that the plan is one at every size and no text is sorted)
    met = flagged.filter(F.col(hit)).join(drops.hint("shuffle_hash"), k, "left")
    rest = flagged.filter(~F.col(hit)).withColumn(dropped, F.lit(None).cast("array<int>"))
    out = met.select(*flagged.columns, dropped).unionByName(rest)
    at = fresh(docs, "_split")
    out, split = out.withColumn(at, F.split(text, "\n", -1)), F.col(at)
    # a set difference of places: linear, however many lines a text has
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(dropped))
    kept = F.array_join(F.transform(places, lambda i: F.get(split, i)), "\n")
    count = F.when(text.isNull(), F.struct(F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))) \
        .otherwise(F.struct(F.size(split).cast("long").alias("n_lines"),
                            F.when(F.col(dropped).isNull(), 0).otherwise(F.size(dropped)).cast("long").alias("n_dropped")))
    return out.withColumn("lines", count) \
        .withColumn(text_col, F.when(F.col(dropped).isNull(), F.col(text_col)).otherwise(kept)).drop(k, hit, dropped, at)


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    out = drop_recurring_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), keyed AS (
  SELECT DISTINCT doc_id, text, ls, len(ls) AS n_lines FROM docs WHERE text IS NOT NULL
), raw AS (
  SELECT doc_id, text, n_lines, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM keyed
), lines AS (
  SELECT doc_id, text, n_lines, pos,
         list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
                        lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
  FROM raw
), leafed AS (
  SELECT *, len(tokens) AS n, tokens[1:3] AS lead FROM lines WHERE len(tokens) >= 4
), leaves AS (
  SELECT n, lead FROM leafed GROUP BY n, lead HAVING count(*) >= 5 AND min(n_lines) < max(n_lines)
), found AS (
  SELECT l.* FROM leafed l JOIN leaves USING (n, lead)
), places AS (
  SELECT n, lead, tokens, unnest(range(n)) AS place, unnest(tokens) AS token FROM found
), often AS (
  SELECT n, lead, place, token FROM places WHERE token <> '<*>' GROUP BY ALL HAVING count(*) >= 5
), parts AS (
  SELECT p.n, p.lead, p.tokens, p.place, CASE WHEN o.token IS NULL THEN '<*>' ELSE p.token END AS t, o.token IS NOT NULL AS stays
  FROM (SELECT DISTINCT * FROM places) p LEFT JOIN often o ON p.n = o.n AND p.lead = o.lead AND p.place = o.place AND p.token = o.token
), templates AS (
  SELECT n, lead, tokens, list(t ORDER BY place) AS template FROM parts GROUP BY n, lead, tokens
  HAVING avg(CASE WHEN stays THEN 1 ELSE 0 END) >= 0.6
), made AS (
  SELECT f.doc_id, f.text, f.n_lines, f.pos, f.n, f.lead, t.template FROM found f JOIN templates t USING (n, lead, tokens)
), support AS (
  SELECT n, lead, template FROM (SELECT DISTINCT n, lead, template, doc_id, text, n_lines FROM made)
  GROUP BY n, lead, template HAVING count(*) >= 5 AND count(DISTINCT n_lines) >= 3
), drops AS (
  SELECT doc_id, text, list(DISTINCT pos) AS dropped FROM made JOIN support USING (n, lead, template) GROUP BY doc_id, text
)
SELECT d.doc_id, coalesce(len(d.ls), 0) AS n_lines, coalesce(len(x.dropped), 0) AS n_dropped,
       sha256(CASE WHEN d.text IS NULL THEN '' WHEN x.dropped IS NULL THEN d.text ELSE
         coalesce(array_to_string([d.ls[i + 1] FOR i IN range(len(d.ls)) IF NOT list_contains(x.dropped, i)], chr(10)), '') END) AS kept_sha256
FROM docs d LEFT JOIN drops x ON d.doc_id = x.doc_id AND d.text = x.text
"""
