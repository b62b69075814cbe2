"""Secret scans: patterns propose candidates, a random forest removes false positives. DataFrame functions only.

The forest sees a candidate's length, its character transitions, how far dictionary words cover it, what its path says (the
column source, and words before the candidate), and the neighbouring words. It is trained on labelled findings; without
a table of such, on made ones: keys and hashes drawn at random in the settings where secrets stand, and placeholders,
checksums, numbers and names where they don't. Trained by Spark's own forest, it is then written out as one SQL
expression, so that a text's candidates are found, judged and masked inside its own row: no join, no shuffle.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole_text

# Private keys, token formats of public services, then assignments to telling names, then any long run of key
# characters. No length has an upper bound, so a candidate is a whole secret and masking leaves no rest of it.
PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s\\]*+(?:-----END [A-Z ]*PRIVATE KEY-----)?"
FORMATS = [PEM, r"AKIA[0-9A-Z]{16,}", r"gh[pousr]_[A-Za-z0-9]{36,}", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"sk_live_[A-Za-z0-9]{16,}", r"AIza[0-9A-Za-z_-]{35,}", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"]
#: A telling name and its sign. The match takes them in, as looking back from every character is slow; they are cut off again.
SIGN = r"(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key|auth)[\"']?\x20?[=:]\x20?[\"']?"
ASSIGNED = SIGN + r"[^\s\"'<>]{7,}[^\s\"'<>,;.)\]}]"
LONG = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9+/_=-])"
CANDIDATE = "|".join([*FORMATS, ASSIGNED, LONG])
#: Characters of text on either side that the forest may look at.
CONTEXT = 48
#: Matches whose lengths are summed together when places are counted.
BLOCK = 128
# Words of placeholders, of paths that hold no live secrets, and of the neighbourhood of either class.
DICTIONARY = (
    "able above across active admin again alert allow array author backup banner batch begin block body bottom bridge browser buffer button cache cancel "
    "case change changeme channel child class clean client clock cloud code column commit company config connect content context cookie count create custom "
    "database debug default demo detail digest display document dummy early empty engine error example export factory feature file filter find folder "
    "format frame function future general graph handle header hello here hidden home house http image index info inner insert install join label large "
    "layer length library limit link load lock long manager master matrix memory message middle model module money mouse name news none null number object "
    "offset open order output package panel part password patch pattern people photo placeholder plain player policy port power press print process profile "
    "project public queue random reader redacted region remote request resource result right route sample schema script second secret select server service "
    "session setting share short simple small sort space stack state status storage stream string subject success support symbol table target team test "
    "text thread title token total transfer trigger type unit upload user valid value vendor version view wait water week widget window your"
).split()
SAFE_PATHS = ["test", "example", "sample", "docs/", "mock", "fixture", "readme"]
SECRET_WORDS = ["token", "secret", "password", "passwd", "key", "auth", "credential", "bearer"]
OTHER_WORDS = ["commit", "sha1", "sha256", "md5", "checksum", "integrity", "digest", "uuid", "revision", "build", "etag", "card", "isbn", "hash"]
FEATURES = ["length", "digits", "upper", "hexadecimal", "variety", "transitions", "runs", "vowels", "covered", "safe_path", "secret_words", "other_words", "assigned", "quoted", "known_format"]
TREES, DEPTH, SEED, MADE_ROWS = 24, 6, 7, 6_000
THRESHOLD = 0.5
MASK = "[secret]"


def _any(words: list[str]) -> str:
    return "(?i)" + "|".join(words)


def _share(value: Column, pattern: str) -> Column:
    """Part of the value's characters that matches of the pattern cover."""
    return (1 - F.length(F.regexp_replace(value, pattern, "")) / F.greatest(F.length(value), F.lit(1))).cast("double")


def feature_columns(value: Column, before: Column, after: Column, path: Column) -> list[Column]:
    """FEATURES of a candidate, in that order."""
    n = F.greatest(F.length(value), F.lit(1))
    changes = F.length(value) - F.length(F.regexp_replace(value, r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]", ""))
    repeats = F.length(value) - F.length(F.regexp_replace(value, r"(.)(?=\1)", ""))
    found = [
        F.length(value), _share(value, "[0-9]"), _share(value, "[A-Z]"), value.rlike("^[0-9A-Fa-f]+$"), F.size(F.array_distinct(F.split(value, ""))) / n, changes / n, repeats / n, _share(value, "(?i)[aeiou]"),
        _share(value, _any(DICTIONARY)), before.rlike(_any(SAFE_PATHS)) | path.rlike(_any(SAFE_PATHS)), before.rlike(_any(SECRET_WORDS)), before.rlike(_any(OTHER_WORDS)), before.rlike(r"[=:]\s?[\"']?$"),
        before.rlike(r"[\"']$") & after.rlike(r"^[\"']"), value.rlike("^(?:" + "|".join(FORMATS) + ")$"),
    ]
    return [c.cast("double").alias(name) for c, name in zip(found, FEATURES, strict=True)]


def with_features(findings: DataFrame) -> DataFrame:
    """Adds FEATURES to rows with value, before, after and, if there, path."""
    path = F.coalesce(F.col("path").cast("string"), F.lit("")) if "path" in findings.columns else F.lit("")
    return findings.select("*", *feature_columns(F.col("value"), F.col("before"), F.col("after"), path))


def located(rows: DataFrame) -> DataFrame:
    """rows with text and path: adds matches (pattern matches in order), gaps (the text around them; null without a match) and
    hits (of each match: value, the context before and after, sign, which is what the match holds before the value).

    One search over the text, a second only where the first finds something. A hit looks at its own gaps and
    neighbouring matches only, so the work stays linear in texts with many.
    """
    found = rows.withColumn("matches", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    cut = found.withColumn("gaps", F.when(F.size("matches") > 0, F.split("text", CANDIDATE, -1)))

    def hit(m: Column, k: Column) -> Column:
        value = F.regexp_replace(m, "^" + SIGN, "")
        sign = F.left(m, F.length(m) - F.length(value))
        last = F.when(k > 0, F.col("matches")[k - 1]).otherwise(F.lit(""))
        following = F.when(k + 1 < F.size("matches"), F.col("matches")[k + 1]).otherwise(F.lit(""))
        before = F.right(F.concat(F.right(last, F.lit(CONTEXT)), F.right(F.col("gaps")[k], F.lit(CONTEXT)), sign), F.lit(CONTEXT))
        after = F.left(F.concat(F.left(F.col("gaps")[k + 1], F.lit(CONTEXT)), F.left(following, F.lit(CONTEXT))), F.lit(CONTEXT))
        return F.struct(value.alias("value"), before.alias("before"), after.alias("after"), sign.alias("sign"))

    return cut.withColumn("hits", F.transform("matches", hit))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, end, value, before, after, path) of every candidate, in code points, end exclusive.

    text_key is a hash of the text, so that rows of one doc_id with different texts stay apart.
    """
    return _placed(located(_texts(docs, "doc_id")), "hits").select("doc_id", "text_key", "start", "end", "h.value", "h.before", "h.after", "path")


def _texts(docs: DataFrame, *names: str) -> DataFrame:
    path = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    return docs.select(*names, whole_text().alias("text"), path.alias("path"))


def _placed(rows: DataFrame, hits: str) -> DataFrame:
    """A row for each hit h, with start and end: sums of what stands before it, by blocks, so a text with many costs little more for each.

    Places are counted before the explode, so no row carries its text's arrays. The outer form of the explode and the filter behind it: a condition on the array before it would be
    pushed into the search, and search the text again for each hit.
    """
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    sizes = F.zip_with(F.slice("gaps", F.lit(1), F.size("matches")), "matches", lambda g, m: (F.length(g) + F.length(m)).cast("long"))
    summed = rows.withColumn("sizes", sizes).withColumn("sums", F.transform(F.sequence(F.lit(0), F.floor(F.size("matches") / BLOCK).cast("int")), lambda b: total(F.slice("sizes", b * BLOCK + 1, BLOCK))))
    block = lambda k: F.floor(k / BLOCK).cast("int")
    starts = F.transform("matches", lambda m, k: total(F.slice("sums", F.lit(1), block(k))) + total(F.slice("sizes", block(k) * BLOCK + 1, k - block(k) * BLOCK)) + F.length(F.col("gaps")[k]))
    zipped = summed.withColumn("starts", starts).withColumn("text_key", F.xxhash64("text")).withColumn("both", F.zip_with(hits, "starts", lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    start = F.col("z.at") + F.length("z.h.sign")
    each = zipped.select("doc_id", "path", "text_key", F.explode_outer("both").alias("z")).where("z is not null")
    return each.select("doc_id", "path", "text_key", "z.h", start.cast("long").alias("start"), (start + F.length("z.h.value")).cast("long").alias("end"))


def made_findings(spark: SparkSession, rows: int = MADE_ROWS) -> DataFrame:
    """Labelled findings (value, before, after, label) made from hashes of row numbers."""
    h = lambda k: F.sha2(F.concat(F.lit(f"{k}-"), F.col("id").cast("string")), 256)
    pick = lambda words, k: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(words))) + 1).cast("int"))
    code = lambda k, n: F.substring(F.translate(F.base64(F.unhex(h(k))), "+/=", "aB7"), 1, n)
    cut, short = (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(3)) * 8 + 24).cast("int"), (F.pmod(F.xxhash64("id", F.lit(30)), F.lit(13)) + 12).cast("int")
    key, sign = pick(["token", "secret", "api_key", "password", "auth_token", "TOKEN", "access_key", "client_secret", "passwd"], 1), pick([' = "', '="', ': "', "=", ": ", " = "], 2)
    plain = pick(["and then the ", "", "some words before it ", "x\n", "path/src/app.py ", "config.yml "], 4)
    safe, other = pick(["tests/fixtures/auth.py ", "docs/example.md ", "README sample ", "mock data "], 5), pick(["commit ", "sha256:", "md5 checksum ", "revision = ", "integrity=", "etag: ", "build hash "], 6)
    word = F.concat_ws("_", *[pick(DICTIONARY, k) for k in (7, 8, 9)])
    digits = F.substring(F.translate(h(10), "abcdef", "012345"), 1, 24)
    longword = F.concat(*[pick(["tion", "ing", "heit", "ment", "keit", "ción", "able", "über", "eaux", "ound"], k) for k in range(20, 28)])
    kinds = [
        (F.concat(plain, key, sign), F.substring(h(11), 1, 40), 1), (F.concat(plain, key, sign), code(12, 40), 1), (F.concat(plain, key, sign), F.upper(F.substring(h(13), 1, 40)), 1),
        (plain, F.concat(F.lit("AKIA"), F.upper(F.substring(h(14), 1, 16))), 1), (plain, F.concat(F.lit("ghp_"), code(15, 36)), 1), (F.concat(plain, key, sign), F.substring(code(16, 40), F.lit(1), cut), 1),
        (F.concat(plain, key, sign), F.substring(h(31), F.lit(1), short), 1), (F.concat(plain, key, sign), F.substring(code(32, 40), F.lit(1), short), 1),
        (F.concat(plain, key, sign), word, 0), (F.concat(plain, key, sign), F.concat(F.lit("your-"), word, F.lit("-here")), 0), (F.concat(plain, key, sign), F.repeat(F.lit("x"), cut), 0),
        (F.concat(plain, other), F.substring(h(17), 1, 40), 0), (F.concat(safe, key, sign), F.concat(F.lit("test_"), F.substring(h(18), 1, 24)), 0), (plain, digits, 0), (plain, longword, 0), (plain, F.substring(h(19), 1, 32), 0),
    ]
    which = F.pmod(F.col("id"), F.lit(len(kinds)))
    choose = lambda at: F.coalesce(*[F.when(which == k, x[at] if at < 2 else F.lit(x[at])) for k, x in enumerate(kinds)])
    made = spark.range(0, rows, 1, 4).select(choose(1).alias("value"), choose(0).alias("before"), choose(2).cast("double").alias("label"))
    return made.withColumn("after", F.when(F.col("before").endswith('"'), F.lit('" more words')).otherwise(F.lit(" more words")))


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    """A forest from labelled findings (value, before, after, label 0 or 1). Rows with a null are ignored."""
    rows = with_features(findings.where("value is not null and before is not null and after is not null and label is not null"))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(rows)


def forest_sql(model: PipelineModel, row: str) -> str:
    """The forest as SQL over a struct `row` with FEATURES: the mean over the trees of the leaves' share of label 1."""

    def written(node) -> str:
        if node.subtreeDepth() == 0:
            zero, one = list(node.impurityStats().stats())
            return repr(one / (zero + one)) + "D"
        split = node.split()
        return f"(CASE WHEN {row}.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D THEN {written(node.leftChild())} ELSE {written(node.rightChild())} END)"

    trees = [written(tree._java_obj.rootNode()) for tree in model.stages[-1].trees]
    return f"(({' + '.join(trees)}) / {len(trees)})"


def judged(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """located() rows, with judged: of each hit sign, value and score."""
    seen = located(rows).withColumn("seen", F.transform("hits", lambda h: F.struct(*feature_columns(h["value"], h["before"], h["after"], F.col("path")))))
    scores = F.expr(f"transform(seen, x -> {forest_sql(model, 'x')})")
    return seen.withColumn("scores", scores).withColumn("judged", F.zip_with("hits", "scores", lambda h, p: F.struct(h["sign"].alias("sign"), h["value"].alias("value"), p.alias("score"))))


def secret_findings(docs: DataFrame, model: PipelineModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: doc_id, text_key, start, end, value_sha256, score, is_secret.

    Null and empty texts have no candidates. Repeated rows give their findings as often as they come; a null doc_id stays null;
    an empty table gives no rows; of other columns only source is read, as the path. Texts without a candidate have no row.
    """
    model = model or train(made_findings(docs.sparkSession))
    rows = _placed(judged(_texts(docs, "doc_id"), model), "judged")
    return rows.select("doc_id", "text_key", "start", "end", F.sha2(F.col("h.value").cast("binary"), 256).alias("value_sha256"), F.round("h.score", 6).alias("score"), (F.col("h.score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, model: PipelineModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """docs with its own columns; secrets in text are replaced by MASK, and n_chars, if there, follows the new text.

    Every row stays, also repeated ones; rows without secrets, null texts among them, are unchanged; an empty table gives no rows.
    """
    model = model or train(made_findings(docs.sparkSession))
    path = F.coalesce(F.col("row.source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = judged(packed.select("row", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"), path.alias("path")), model)
    pieces = F.zip_with("matches", "judged", lambda m, h: F.when(h["score"] >= threshold, F.concat(h["sign"], F.lit(MASK))).otherwise(m))
    masked = F.concat(F.array_join(F.zip_with(F.slice("gaps", F.lit(1), F.size("matches")), pieces, lambda g, p: F.concat(g, p)), ""), F.element_at("gaps", -1))
    hit = F.exists("scores", lambda p: p >= threshold)
    cleaned = rows.select("row", F.when(hit, masked).alias("cleaned"))
    out = {"text": F.coalesce("cleaned", "row.text"), "n_chars": F.when(F.col("cleaned").isNotNull(), F.length("cleaned")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return cleaned.select(*[(out[c].cast(t) if c in out else F.col(f"row.`{c}`")).alias(c) for c, t in docs.dtypes])
