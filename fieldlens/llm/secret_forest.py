"""Secret scans with a random forest that removes false positives, with DataFrame functions and the ML library of the JVM.

Candidates are runs of 16 or more characters of the alphabets in which keys are written, and shorter values of letters and digits that are
assigned to a credential's name; the latter are secrets by that rule. Features of a candidate: length, transitions between
classes of characters, digits, hexadecimal digits, distinct characters, coverage by dictionary words, a path around it, quotes, an assignment,
and words beside it that name credentials. The forest learns from labelled findings and scores every candidate.

Null and empty texts have no candidates. Repeated rows are scanned each. Rows with a null id are scanned too. An empty table gives no rows.
Only the id and the text are read, so other columns can't clash. With labels of fewer than two kinds nothing can be learnt, and rules decide:
known formats, and mixed values assigned to a credential's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import row_key, saved, sized

CANDIDATE = (r"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{16,}+={0,2}|"
             r"""(?:(?<=[=:])|(?<=[=:] )|(?<=[=:]["'`])|(?<=[=:] ["'`]))(?=[A-Za-z_+/\-]{0,15}[0-9])(?=[0-9_+/\-]{0,15}[A-Za-z])"""
             r"[A-Za-z0-9_+\-][A-Za-z0-9_+/\-]{5,14}(?![A-Za-z0-9_+/\-])")
LONG = 16
#: Labelled findings that the forest is fitted on at most: distinct ones, up to half of each label, the first in the order of a hash.
LABELLED = 20_000
#: Fixed words that are common in identifiers, paths and placeholders.
DICTIONARY = ("access account address admin android api app application assets auth build bucket cache class client cloud code com common config "
              "content data database default demo dev docs document domain download example file first foo format group home html http https id "
              "image img index info item java key last lib library list local log login main message model module name net node number object "
              "option org package page param path placeholder port print private product project public python query random release report "
              "request resource response result root route sample schema script secret server service session settings source spark static "
              "status store string style system table target temp test text theme time title token tool type update upload url user util value "
              "version video view web window work www your").split()
NAMES = r"(?i)(api[_-]?key|access[_-]?key|secret|token|passw(or)?d|pwd|credential|auth|bearer|private[_-]?key|client[_-]?id)"
#: What stands before a short value that is a candidate.
SHORT_NAMES = (r"(?i)(api[_-]?key|access[_-]?key|secret([_-]?key)?|token|passw(or)?d|pwd|credentials?|private[_-]?key|client[_-]?secret)"
               r"[\"'`]?\s?[=:]\s?[\"'`]?$")
HEX = "^([0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$"
PREFIXED = ("^((AKIA|ASIA)[A-Z0-9]{16}$|gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk[-_](live|test|proj)?[-_]?[A-Za-z0-9]{20,}|"
            "eyJ[A-Za-z0-9_-]{16,})")
FEATURES = ["length", "transitions", "digits", "hex_digits", "distinct_chars", "coverage", "vowels", "path", "quoted", "assigned", "named"]


def _share(value: Column, kept: str) -> Column:
    """Share of the characters that are outside the class ``kept``."""
    return F.length(F.regexp_replace(value, kept, "")) / F.length(value)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, nth, secret, before, after) of all candidates in all texts; no text is carried along."""
    found = docs.select("doc_id", "text").filter(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("_found"), F.split("text", CANDIDATE, -1).alias("_between"))
    runs = F.transform("_found", lambda c, i: F.struct(
        c.alias("secret"), F.right(F.get("_between", i), F.lit(40)).alias("before"), F.left(F.get("_between", i + 1), F.lit(20)).alias("after")))
    runs = F.filter(runs, lambda c: (F.length(c["secret"]) >= LONG) | c["before"].rlike(SHORT_NAMES))
    listed = found.select("doc_id", F.posexplode(runs).alias("nth", "_c"))
    return listed.select("doc_id", "nth", "_c.*")


def features(found: DataFrame) -> DataFrame:
    """Candidates with the columns of ``FEATURES``, all doubles."""
    s, before, after = F.col("secret"), F.col("before"), F.col("after")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "0"), "[^ab0]+", "-")
    columns = {
        "length": F.length(s), "transitions": (F.length(kinds) - 1) / F.length(s), "digits": _share(s, "[^0-9]"),
        "hex_digits": _share(s, "[^0-9a-fA-F]"), "distinct_chars": F.size(F.array_distinct(F.split(s, ""))) / F.length(s),
        "coverage": 1 - _share(F.lower(s), "(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")"),
        "vowels": _share(F.lower(s), "[^aeiou]"),
        "path": (before.rlike(r"(://|[./\\])[^\s]*$") | s.rlike("/.*/") | after.rlike(r"^[./\\]\w")).cast("int"),
        "quoted": (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("int"),
        "assigned": before.rlike(r"[=:]\s*[\"'`]?$").cast("int"), "named": before.rlike(NAMES + r"[^\n]{0,12}$").cast("int")}
    return found.select("*", *[c.cast("double").alias(n) for n, c in columns.items()])


def labelled(found: DataFrame) -> DataFrame:
    """Findings with a label where rules are certain: 1.0 for a known format that is assigned to a credential's name, 0.0 for numbers,
    words, and dictionary compounds. The others carry no label."""
    s = F.col("secret")
    known = s.rlike(HEX) | s.rlike(PREFIXED)
    certain = known & (F.col("digits") > 0.1) & (F.col("named") == 1) & (F.col("assigned") == 1)
    plain = s.rlike("^[0-9]+$") | s.rlike("^[A-Za-z]+$") | s.rlike("^[-_=+/]+$") | ((F.col("coverage") > 0.6) & (F.col("digits") < 0.2))
    return found.withColumn("label", F.when(certain, 1.0).when(plain, 0.0)).filter("label is not null")


def ruled(found: DataFrame) -> DataFrame:
    """Candidates with ``probability`` 1.0 where a rule alone tells a secret, 0.0 elsewhere: keys of a format with a prefix, hexadecimal keys
    beside a credential's name, and values with letters and digits that are assigned to one."""
    s, named = F.col("secret"), F.col("named") == 1
    mixed = s.rlike("[0-9]") & s.rlike("[A-Za-z]") & (F.col("coverage") <= 0.6) & (F.col("path") == 0)
    return found.withColumn("probability", (s.rlike(PREFIXED) | (s.rlike(HEX) & named) | (named & (F.col("assigned") == 1) & mixed)
                                            | (F.length(s) < LONG)).cast("double"))


def scored(found: DataFrame, findings: DataFrame, *, trees: int = 20, depth: int = 5, seed: int = 17) -> DataFrame:
    """Candidates with ``probability`` of being a secret, from a forest fitted on ``findings``: (secret, before, after, label)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    distinct = findings.select("secret", "before", "after", "label").filter(F.length("secret") >= LONG).distinct()
    order = F.xxhash64("secret", "before", "after")
    halves = [distinct.filter(F.col("label") == label).orderBy(order, "secret", "before", "after").limit(LABELLED // 2) for label in (0.0, 1.0)]
    fit = saved(halves[0].unionByName(halves[1]))
    kinds = {r["label"] for r in fit.select("label").distinct().collect()}
    measured = features(found)
    if kinds != {0.0, 1.0}:
        return ruled(measured).select(*found.columns, "probability")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw",
                                    predictionCol="_prediction", numTrees=trees, maxDepth=depth, seed=seed)
    model = forest.fit(assembler.transform(features(fit).coalesce(1)))
    return model.transform(assembler.transform(measured)).select(
        *found.columns, F.when(F.length("secret") < LONG, 1.0).otherwise(vector_to_array("_probability")[1]).alias("probability"))


def scan(docs: DataFrame, findings: DataFrame | None = None, *, threshold: float = 0.5) -> DataFrame:
    """(doc_id, nth, secret, probability) of the secrets in all documents. Without labelled ``findings`` the certain ones of ``docs`` teach."""
    found = saved(candidates(docs))
    if findings is None:
        findings = labelled(features(found.filter(F.length("secret") >= LONG))).select("secret", "before", "after", "label")
    return scored(found, findings).filter(F.col("probability") >= threshold).select("doc_id", "nth", "secret", "probability")


def without_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced in the text; no document goes."""
    secrets = sized(scan(docs.select(row_key(docs).alias("doc_id"), "text")).groupBy(F.col("doc_id").alias("_key")).agg(F.collect_set("secret").alias("_secrets")), 100_000)
    named = docs.join(secrets, row_key(docs) == F.col("_key"), "left")
    text = F.when(F.col("_secrets").isNull(), F.col("text")).otherwise(
        F.aggregate(F.array_sort("_secrets", lambda a, b: F.length(b) - F.length(a)), F.col("text"), lambda t, s: F.replace(t, s, F.lit(mark))))
    new = {"text": text} | ({"n_chars": F.when(F.col("_secrets").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long")} if "n_chars" in docs.columns else {})
    return named.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])


def op2(docs: DataFrame) -> DataFrame:
    return scan(docs)
