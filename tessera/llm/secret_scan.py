"""Secret scanning: candidate strings, and a random forest that removes false positives.

Candidates are long runs of key-like characters, tokens of parts joined by dots, values
assigned to a name (also inside another value), and private-key headers. The forest judges each by its length, character classes and transitions, the
share of its letter runs that the corpus's own words cover, path signs, and the words
beside it. It is trained on labelled findings; without a labelled table, candidates of
unmistakable form (issuer prefixes, values assigned to a secret's name; plain words and
numbers) are the labelled ones, and all others are left to the forest. Only DataFrame
and ML functions that run in the JVM are used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize

RUN = r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}+={0,2}"
DOTTED = r"(?<![A-Za-z0-9_\-.])(?=[A-Za-z0-9_\-]++\.[A-Za-z0-9_\-])[A-Za-z0-9_\-.]{15,}[A-Za-z0-9_\-]"
#: The value is only looked at, so that the search goes on inside it.
ASSIGNED = (r"""(?i)(?<![a-z0-9_\-])(?=[0-9_\-]*+[a-z])[a-z0-9_\-]++["']?\s?(?:=>|:=|=|:)\s?["']?"""
            r"""(?=([^\s"',;()<>]{6,}))""")
HEADER = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
#: Names that secrets are assigned to, and prefixes of issued keys.
CUE = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|auth|credential|private.?key|bearer)"
ISSUED = (r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[baprs]-[A-Za-z0-9\-]{10,}|sk-[A-Za-z0-9\-]{20,}|"
          r"AIza[A-Za-z0-9_\-]{35}|eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-.]+|-----BEGIN .*)$")

FEATURES = ["length", "digits", "upper", "lower", "marks", "vowels", "turns", "case_turns", "different", "hex",
            "covered", "slashes", "path", "assigned", "quoted", "cue_beside", "cue_near"]
WORD_ROWS = 20_000


def dictionary(docs: DataFrame, words: int = WORD_ROWS) -> DataFrame:
    """``(gram)``: the 4-letter runs of the corpus's ``words`` most frequent words of 4 to 15
    letters, by number of documents; at most 12 * ``words`` rows."""
    split = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")
    each = docs.select(F.array_distinct(split).alias("w")).select(F.explode_outer("w").alias("w"))
    top = (each.where(F.length("w").between(4, 15)).groupBy("w").agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), "w").limit(words))
    return top.where("n > 1").select(F.explode(_grams("w")).alias("gram")).distinct()


def _grams(col: str) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(col) - 3), lambda i: F.substring(F.col(col), i, F.lit(4)))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` -> one row per document and different candidate:
    ``(doc_id, candidate, first_pos, n_found, before, after)``: the first place (from 1), the
    occurrences, and up to 40 characters on both sides of the occurrence that speaks most
    for a secret (a name beside it, an assignment, a name near, a quote), of equal ones the first."""
    all_of = lambda p, group: F.regexp_extract_all("text", F.lit(p), F.lit(group))
    found = docs.select("doc_id", "text", F.array_distinct(F.concat(
        all_of(RUN, 0), all_of(DOTTED, 0), all_of(ASSIGNED, 1), all_of(HEADER, 0))).alias("found")).where("text is not null")
    one = found.select("doc_id", "text", F.explode_outer("found").alias("candidate")).where("candidate is not null")
    literal = F.concat(F.lit("\\Q"), F.replace("candidate", F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    cut = one.select("doc_id", "candidate", F.split("text", literal, -1).alias("parts"))
    part = lambda i: F.coalesce(F.get("parts", i), F.lit(""))

    def beside(i: Column) -> Column:  # the occurrence after part i, and its neighbours' texts
        before = F.concat(F.when(i > 0, F.concat(F.right(part(i - 1), F.lit(40)), "candidate")).otherwise(""), part(i))
        after = F.concat(part(i + 1), F.when(i + 2 < F.size("parts"), F.concat(
            "candidate", F.left(part(i + 2), F.lit(40)))).otherwise(""))
        return F.struct((-i).alias("turn"), F.right(before, F.lit(40)).alias("before"), F.left(after, F.lit(40)).alias("after"))

    def strength(x: Column) -> Column:
        marks = _context(x["before"], x["after"])
        return F.struct((8 * marks["cue_beside"] + 4 * marks["assigned"] + 2 * marks["cue_near"] + marks["quoted"]).alias("s"),
                        x["turn"].alias("turn"), x["before"].alias("before"), x["after"].alias("after"))

    each = cut.select("doc_id", "candidate", F.length(F.get("parts", F.lit(0))).alias("skipped"), F.transform(
        F.sequence(F.lit(0), F.size("parts") - 2), beside).alias("places"))
    best = each.select("doc_id", "candidate", "skipped", F.size("places").alias("n"),
                       F.array_max(F.transform("places", strength)).alias("best"))
    return best.select("doc_id", "candidate", (F.col("skipped") + 1).cast("long").alias("first_pos"),
                       F.col("n").cast("long").alias("n_found"), "best.before", "best.after")


def _context(before: Column, after: Column) -> dict[str, Column]:
    flag = lambda cond: cond.cast("double")
    return {"assigned": flag(before.rlike(r"""[=:>]\s?["']?$""")), "quoted": flag(before.rlike(r"""["']$""")),
            "cue_beside": flag(before.rlike(CUE + r"""[A-Za-z0-9_\-]*["']?\s?[=:>]*\s?["']?$""")),
            "cue_near": flag(F.concat_ws(" ", before, after).rlike(CUE))}


def with_features(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES`` (doubles)."""
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda p: F.regexp_count(c, F.lit(p)) / n
    flag = lambda cond: cond.cast("double")
    texts = found.select("candidate").distinct().withColumn("low", F.lower("candidate"))
    pieces = texts.where(F.length("low") >= 4).select("candidate", F.explode(_grams("low")).alias("gram"))
    covered = (pieces.join(broadcast_if_small(grams.withColumn("hit", F.lit(1.0))), "gram", "left")
               .groupBy("candidate").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("covered")))
    out = found.join(covered, "candidate", "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))
    new = {
        "length": n.cast("double"), "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"),
        "marks": share("[^A-Za-z0-9]"), "vowels": share("(?i)[aeiou]"),
        "turns": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "case_turns": share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "different": F.size(F.array_distinct(F.split(c, ""))) / n, "hex": flag(c.rlike("^[0-9a-fA-F]+$")),
        "slashes": F.regexp_count(c, F.lit("/")).cast("double"),
        "path": flag(F.col("before").rlike(r"[/\\.~]$") | F.col("after").rlike(r"^[/\\]|^\.[a-z]") | c.rlike(r"^//|^[a-z]+/[a-z]+/")),
        **_context(F.col("before"), F.col("after"))}
    return out.select("*", *[v.alias(k) for k, v in new.items()])


def seed_labels(featured: DataFrame) -> DataFrame:
    """``featured`` with ``label``: 1 and 0 for candidates of unmistakable form, else null."""
    c = F.col("candidate")
    named = (F.col("cue_beside") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0) & (F.col("covered") < 0.3)
    plain = c.rlike("^[A-Za-z_/-]+$") & (F.col("cue_beside") == 0)
    return featured.withColumn("label", F.when(c.rlike(ISSUED) | named, 1.0).when(
        (plain & (F.col("covered") > 0.2)) | c.rlike("^[0-9-]+$") | ((F.col("path") == 1) & (F.col("covered") > 0.4)), 0.0))


def train(labelled: DataFrame, sample: int = 10_000, trees: int = 40, depth: int = 6, seed: int = 11
          ) -> RandomForestClassificationModel | None:
    """Forest from at most ``sample`` labelled findings of each class (columns ``FEATURES``,
    ``label``; smallest hash of the finding first); None without findings of both."""
    pick = [labelled.where(F.col("label") == y).select(*FEATURES, "label", "candidate", "before")
            .orderBy(F.xxhash64("candidate", "before"), "candidate", "before").limit(sample) for y in (0.0, 1.0)]
    rows = materialize(pick[0].unionByName(pick[1]).coalesce(1), "secret-training")
    if rows.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.repartition(1).sortWithinPartitions(
        F.xxhash64("candidate", "before"), "candidate", "before"))
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth,
                                  seed=seed).fit(vectors)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) -> one row per document row and different secret:
    ``(doc_id, secret, first_pos, n_found, score)`` with the forest's probability.

    ``labelled (candidate, before, after, label)`` replaces the seed labels. With nothing to
    learn from, candidates of unmistakable form are returned with score 1. Null and empty
    texts hold nothing. Repeated rows give repeated findings; null ids stay null; other
    columns are ignored. Empty input: empty result."""
    docs = docs.select("doc_id", "text")
    grams = materialize(dictionary(docs), "secret-grams")
    found = materialize(candidates(docs), "secret-candidates")
    featured = materialize(with_features(found, grams), "secret-features")
    seeds = seed_labels(featured)
    if labelled is not None:
        seeds = with_features(labelled, grams)
    model = train(seeds.where("label is not null"))
    if model is None:
        judged = seed_labels(featured).withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        judged = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured)
                                 ).withColumn("score", vector_to_array("probability")[1])
    return judged.where(F.col("score") >= threshold).select(
        "doc_id", F.col("candidate").alias("secret"), "first_pos", "n_found", "score")
