"""Secret scans: pattern candidates, and a random forest that removes false positives.

Candidates are of three kinds: ``value``, what stands after a key word and ``=`` or ``:``
(any characters but spaces, quotes and separators); ``login``, the password of ``user:password@host``;
``run``, a run of at least ``LEAST`` letters, digits and ``+/_-`` with both letters and digits or a
change from lower to upper case.  The forest sees a candidate's length, its character transitions and
classes, how much of it dictionary words cover, the path, and the words before and after; it
is trained on labelled findings (Spark MLlib, at most about ``SAMPLE`` of them a class).  Where no
findings were labelled by hand, ``labelled`` derives labels from formats that issuers publish,
from assignments to key words, and from plain numbers and names.  The flags that these rules read
(key word, assigned, sample near) are not among the forest's inputs; the word before a candidate
is, so derived labels are still easier to learn than real ones.  DataFrame functions only; texts
are scanned once and only findings are shuffled.

Defined cases: NULL or empty text has no findings; NULL path counts as empty; a candidate that
occurs several times in a document is a finding each time, and kinds don't overlap (value before
login before run); rows that share a doc_id give their findings each; without labels of both
classes every candidate is reported, with score 1; an empty table gives no rows; columns other
than doc_id, text and the path column are ignored; the characters U+0001 and U+0002 count as
spaces; places are found in slices of ``SLICE`` findings, so a long text costs in proportion.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.llm.shared import let, stage

LEAST, SAMPLE, TREES, DEPTH, THRESHOLD, MASK, SLICE = 8, 50_000, 20, 6, 0.5, "[SECRET]", 256
#: Marks around candidates while a text is scanned.
OPEN, SHUT = "\x01", "\x02"
KEYS = r"passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credentials?"
VALUE = rf"(?i)((?:{KEYS})[\"']?\s{{0,4}}[:=]\s{{0,4}}[\"']?)([^\s\"',;<>()\[\]{{}}]{{4,}})"
LOGIN = rf"([A-Za-z0-9._-]+:)([^\s:/@\"'<>{OPEN}{SHUT}]{{4,}})(@[A-Za-z0-9])"
RUN = rf"({OPEN}[^{SHUT}]*{SHUT})|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|[A-Za-z0-9+/_-]*?[a-z][A-Z])([A-Za-z0-9+/_-]{{{LEAST},}}+)"
#: Words that cover ordinary identifiers and placeholders.
DICTIONARY = ("example sample test dummy placeholder changeme default value name user admin file path data index table list "
              "number string object class public private local host server client page image style script version update "
              "create delete insert select group order event date time year month week the and for with from that this "
              "der die und les des une los las que para pour avec").split()
KEY_WORDS = rf"(?i)({KEYS})\W*$"
HASH_WORDS = r"(?i)(sha-?\d*|md5|commit|checksum|digest|uuid|revision|build|id|no|nr)\W*$"
FEATURES = ["length", "transitions", "digits", "uppers", "distinct", "hex", "covered", "test_path", "path_depth", "quoted", "hash_word", "word_before", "word_after"]


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, text_key (a hash of the text), path, candidate, start (from 1), and the text before (from the candidate before, if there is one) and after (up to the next)."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), OPEN + SHUT, "  ")
    marked = F.regexp_replace(text, VALUE, f"$1{OPEN}$2{SHUT}")
    marked = F.regexp_replace(marked, LOGIN, f"$1{OPEN}$2{SHUT}$3")
    marked = F.replace(F.regexp_replace(marked, RUN, f"$1{OPEN}$2{SHUT}"), F.lit(OPEN + SHUT), F.lit(""))  # nothing stands between after a candidate marked before
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), marked.alias("marked"))
    rows = rows.where(F.contains("marked", F.lit(OPEN)))

    # pieces after the first: a candidate, SHUT, the text up to the next candidate
    size = lambda piece: F.length(piece) - F.when(F.contains(piece, F.lit(SHUT)), 1).otherwise(0)
    bare = lambda piece: F.replace(piece, F.lit(SHUT), F.lit(""))

    def ends(sizes: Column, start: Column) -> Column:
        """Where each of the pieces starts, and at last where the next one does."""
        return F.aggregate(sizes, F.array(start), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))

    def sliced(pieces: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(pieces) - 1) / SLICE).cast("int")), lambda i: F.slice(pieces, i * SLICE + 1, SLICE))

    def placed(slices: Column) -> Column:
        totals = F.transform(slices, lambda part: F.aggregate(part, F.lit(0), lambda acc, p: acc + size(p)))
        return F.transform(F.arrays_zip(slices.alias("part"), ends(totals, F.lit(1)).alias("start")), lambda z, i: F.struct(z["part"].alias("part"), z["start"].alias("start"), F.when(i > 0, F.element_at(F.get(slices, i - 1), -1)).otherwise("").alias("last")))

    def found_in(z: Column) -> Column:
        def one(p: Column, i: Column, starts: Column) -> Column:
            before = F.right(bare(F.when(i > 0, F.get(z["part"], i - 1)).otherwise(z["last"])), F.lit(48))
            after = F.left(F.substring_index(p, SHUT, -1), F.lit(32))
            return F.struct(F.substring_index(p, SHUT, 1).alias("candidate"), F.get(starts, i).alias("start"), before.alias("before"), after.alias("after"), F.contains(p, F.lit(SHUT)).alias("is_one"))

        return let(ends(F.transform(z["part"], size), z["start"]), lambda starts: F.transform(z["part"], lambda p, i: one(p, i, starts)))

    each = rows.select("doc_id", "text_key", "path", F.explode(let(sliced(F.split("marked", OPEN)), placed)).alias("z")).where("z.part is not null")
    each = each.select("doc_id", "text_key", "path", F.explode(found_in(F.col("z"))).alias("f")).where("f.is_one and f.candidate <> ''")
    c = F.col("candidate")
    key_or_login = F.col("before").rlike(rf"(?i)({KEYS})[\"']?\s*[:=]\s*[\"']?$") | (F.col("before").rlike("[A-Za-z0-9._-]:$") & F.col("after").startswith("@"))
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]") | c.rlike("[a-z][A-Z]") | (c.rlike("[0-9]") & (F.length(c) >= 14))
    return each.select("doc_id", "text_key", "path", "f.candidate", "f.start", "f.before", "f.after").where(key_or_login | mixed)


def featured(found: DataFrame) -> DataFrame:
    c, n = F.col("candidate"), F.length("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A"), "[^0aA]", "-")
    only = lambda kind: F.length(F.regexp_replace(c, f"[^{kind}]", "")) / n
    flag = lambda x: x.cast("double")
    bucket = lambda word: F.pmod(F.xxhash64(F.lower(word)), F.lit(32)).cast("double")
    made = {
        "length": flag(n), "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / n, "digits": only("0-9"), "uppers": only("A-Z"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n, "hex": flag(c.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "covered": 1 - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / n,
        "test_path": flag(F.col("path").rlike("(?i)test|example|sample|fixture|mock|docs?/")), "path_depth": flag(F.size(F.split("path", "/"))),
        "key_word": flag(F.col("before").rlike(KEY_WORDS)), "assigned": flag(F.col("before").rlike(r"[=:]\s*[\"']?$")), "quoted": flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "hash_word": flag(F.col("before").rlike(HASH_WORDS)), "sample_near": flag(F.concat("before", F.lit(" "), "after").rlike("(?i)example|dummy|placeholder|sample")),
        "word_before": bucket(F.regexp_extract("before", r"(\w+)\W*$", 1)), "word_after": bucket(F.regexp_extract("after", r"(\w+)", 1)),
    }
    return found.withColumns(made)


def labelled(found: DataFrame) -> DataFrame:
    """Findings whose label follows from a published format (1) or from being a plain number or name (0)."""
    c = F.col("candidate")
    issued = c.rlike(r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$")
    assigned = (F.col("key_word") == 1) & (F.col("assigned") == 1) & c.rlike("[0-9]") & c.rlike("[A-Za-z]") & (F.col("sample_near") == 0)
    plain = c.rlike(r"^[0-9/_+-]+$|^[A-Za-z]+([/_-][A-Za-z]+)*[0-9]{0,4}$")
    return found.withColumn("label", F.when(issued | assigned, F.lit(1.0)).when(plain, F.lit(0.0))).where("label is not null")


def train(known: DataFrame, size: int = SAMPLE):
    """A forest fitted to labelled findings (featured, with label), or None without both classes."""
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not (n.get(0.0) and n.get(1.0)):
        return None
    part = F.when(F.col("label") == 1, F.lit(size / n[1.0])).otherwise(F.lit(size / n[0.0])) * 1_000_000
    rows = known.where(F.pmod(F.xxhash64("doc_id", "candidate"), F.lit(1_000_000)) < part)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=1).fit(rows)


def judged(found: DataFrame, forest) -> DataFrame:
    """Adds score and is_secret to featured findings."""
    if forest is None:
        return found.withColumns({"score": F.lit(1.0), "is_secret": F.lit(True)})
    rows = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    score = vector_to_array("probability")[1]
    return rows.withColumns({"score": score, "is_secret": score >= THRESHOLD})


def scan(docs: DataFrame, path: str = "source", known: DataFrame | None = None) -> DataFrame:
    """All findings with score and is_secret; ``known``: labelled findings, else derived ones."""
    found = stage(featured(findings(docs, path)), "findings")
    return judged(found, train(labelled(found) if known is None else known))


def masked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every secret of its text replaced by ``MASK``; other columns as they are.

    A secret is masked at all places where the same text has it as a candidate; a text is searched for
    its own secrets only, whether or not its doc_id is NULL or repeated.
    """
    # copies of a text give the same places, which are put together before the shuffle
    secrets = found.groupBy("text_key", "candidate").agg(F.max("is_secret").alias("found"), F.collect_set("start").alias("starts")).where("found")
    each = F.transform("starts", lambda s: F.struct(s.alias("start"), F.length("candidate").alias("n")))
    per_text = secrets.groupBy("text_key").agg(F.sort_array(F.flatten(F.collect_list(each)), asc=False).alias("places"))
    rows = docs.select(F.struct("*").alias("row"))  # no name of docs can clash with those used here
    text = F.aggregate("places", F.col("row.text"), lambda acc, p: F.overlay(acc, F.lit(MASK), p["start"], p["n"]))
    masked_text = F.when(F.col("places").isNull(), F.col("row.text")).otherwise(text)
    return rows.join(per_text, F.xxhash64("row.text") == F.col("text_key"), "left").select(*[masked_text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op1(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return scan(docs).select("doc_id", "candidate", "start", F.round("score", 6).alias("score"), "is_secret", *FEATURES[:7])
