"""Secret scan: candidates by pattern, a random forest to drop false positives.

A candidate is a run of 12 or more key characters with a digit, or any run of 6 or more characters
without blanks that follows a secret word and an assignment, up to the closing quote if it is quoted. Its features are
length, changes between character classes, shares of digits, capitals, signs and distinct
characters, coverage by dictionary words, whether it is a stand-in for a value, whether it stands in a path or address, and
the words beside it. The forest is trained from labelled findings; the default ones
are built by rule from kinds of keys and of look-alikes (``labelled_findings``), and any table of the same
columns may take their place.

Only DataFrame and SQL functions are used; the forest is Spark ML's. Scanning shuffles
nothing. Texts without a candidate are never exploded. A null text has no candidates; rows
with equal ids are scanned each for itself; an empty table gives no findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common
from mergewright.sources.staging import stage

KEY = "A-Za-z0-9+/_-"
CONTEXT = 48
MASK = "<SECRET>"
#: Words beside secrets, words beside look-alikes, dictionary words inside names.
SECRET_WORDS = "token|secret|password|passwd|pwd|api_?-?key|access_?-?key|private_?-?key|credential|auth|bearer|signing"
#: What stands where a value would: nothing is told by it.
PLAIN_VALUES = (r"required|optional|string|undefined|default|missing|invalid|expired|enabled|disabled|hidden|redacted|changeme|"
                r"boolean|integer|unknown|secret|password|<.*>?|\$?\{+.*\}*|%.*%|[*.x_-]+|[\w.]+[(\[].*")
PLAIN_WORDS = ("commit|revision|checksum|digest|md5|sha1|sha256|etag|uuid|guid|isbn|issn|doi|version|build|order|invoice|"
               "card|phone|tel|fax|serial|part|page|id|ref|index|hash|at|on|to|of|and|the")
DICTIONARY = ("about|account|action|after|article|blog|build|button|category|class|client|config|content|data|default|"
              "document|download|email|error|event|example|file|first|function|group|home|image|index|info|item|library|"
              "link|list|login|main|message|method|model|module|month|name|news|number|object|order|page|part|path|"
              "post|product|project|public|query|record|release|report|request|response|result|section|server|service|"
              "source|start|static|status|string|system|table|test|text|time|title|type|update|user|value|version|view|web|"
              "week|world|year")
#: A run of key characters with a digit; and what is assigned to a secret word, to the closing quote or, without quotes, to a
#: blank, less punctuation at its end. Looks behind begin with the sign of assignment, which prose seldom has.
RUN = rf"(?<![{KEY}])(?=[A-Za-z+/_-]*+[0-9])[{KEY}]{{12,}}+={{0,2}}"
NAMED = (rf"""(?<=[:=>]\s{{0,2}}["'`]?)(?<=(?i:{SECRET_WORDS})[\w-]{{0,8}}["']?\s{{0,2}}(?:=>|:=|==?|:)\s{{0,2}}["'`]?)"""
         r"""(?!(?i:bearer|basic)\b)(?:(?<=")[^\s"]{6,}+|(?<=')[^\s']{6,}+|(?<=`)[^\s`]{6,}+|(?<!["'`])"""
         r"""(?=[^\s"'`=:>])[^\s"'`]{5,}[^\s"'`.,;:)\]}])""")
CANDIDATE = f"{NAMED}|{RUN}"
FEATURES = ("f_length", "f_changes", "f_digits", "f_capitals", "f_distinct", "f_hex", "f_only_digits", "f_covered",
            "f_path", "f_secret_word", "f_plain_word", "f_assigned", "f_quoted", "f_dashes", "f_signs", "f_plain_value", "f_equals")
TREES, TREE_DEPTH = 30, 6
THRESHOLD = 0.5
PER_KIND = 60


def with_features(found: DataFrame) -> DataFrame:
    """``found`` (before, candidate, after) with the features."""
    c, before, after = F.col("candidate"), F.lower("before"), F.col("after")
    n = F.length(c).cast("double")
    runs = sum(F.regexp_count(c, F.lit(p)) for p in ("[a-z]+", "[A-Z]+", "[0-9]+", "[^A-Za-z0-9]+"))
    left = F.length(F.regexp_replace(F.lower(c), DICTIONARY, ""))
    columns = {
        "f_length": n,
        "f_changes": (runs - 1) / n,
        "f_digits": F.regexp_count(c, F.lit("[0-9]")) / n,
        "f_capitals": F.regexp_count(c, F.lit("[A-Z]")) / n,
        "f_distinct": F.size(F.array_distinct(F.split(F.substring(c, 1, 64), ""))) / F.least(n, F.lit(64.0)),
        "f_hex": c.rlike(r"^[0-9a-f]+$"),
        "f_only_digits": c.rlike(r"^[0-9-]+$"),
        "f_covered": 1 - left / n,
        "f_path": before.rlike(r"(://[^\s]*|[./\\]|[?&]\w*=)$") | c.rlike("/.*/"),
        "f_secret_word": before.rlike(rf"({SECRET_WORDS})\W{{0,6}}(\w{{1,8}}\W{{1,3}})?$"),
        "f_plain_word": before.rlike(rf"\b({PLAIN_WORDS})\W{{0,4}}$"),
        "f_assigned": before.rlike(r"""[:=]\s?["']?$"""),
        "f_quoted": before.rlike("""["']$""") & after.rlike("""^["']"""),
        "f_dashes": F.regexp_count(c, F.lit("[-_]")) / n,
        "f_signs": F.regexp_count(c, F.lit(rf"[^={KEY}]")) / n,
        "f_plain_value": F.lower(c).rlike(f"^({PLAIN_VALUES})$"),
        "f_equals": before.rlike(r"""=>?\s{0,2}["'`]?$"""),
    }
    return found.withColumns({k: v.cast("double") for k, v in columns.items()})


#: Kinds of labelled findings: label, text before, value's head, form, from, length, value's tail, text after.
KINDS = (
    (1, 'token = "', "", "hex", 1, 40, "", '"'), (1, "token: ", "", "mixed", 1, 36, "", " "),
    (1, "password=", "", "hex", 1, 18, "", " "), (1, 'password = "', "", "mixed", 1, 20, "", '"'),
    (1, "", "AKIA", "capitals", 1, 16, "", " "), (1, "key ", "AKIA", "capitals", 3, 16, "", " "),
    (1, "", "ghp_", "mixed", 1, 36, "", " "), (1, "secret: ", "", "hex", 1, 32, "", " "),
    (1, "api_key='", "", "mixed", 1, 32, "", "'"), (1, "Authorization: Bearer ", "", "mixed", 1, 60, "", " "),
    (1, "", "sk_live_", "mixed", 1, 24, "", " "), (1, 'secret_key = "', "", "hex", 1, 64, "", '"'),
    (1, 'password = "', "", "signs", 1, 10, "", '"'), (1, "password: ", "", "signs", 5, 12, "", " "),
    (1, "passwd=", "", "hex", 1, 8, "", " "), (1, "pwd: '", "", "mixed", 1, 8, "", "'"), (1, "password: ", "", "mixed", 3, 10, "", " "),
    (1, "secret: ", "", "letters", 1, 20, "", " "), (1, 'secret = "', "", "letters", 1, 14, "", '"'),
    (1, "passwd=", "", "letters", 1, 6, "", " "), (1, "passwd=", "", "letters", 3, 7, "42", " "), (1, "pwd=", "", "digits", 1, 8, "", " "),
    (0, "password: ", "required", "letters", 1, 0, "", " "), (0, 'secret: "', "undefined", "letters", 1, 0, "", '"'),
    (0, "token: ", "string", "letters", 1, 0, "", " "), (0, "password = ", "<your-", "letters", 1, 8, ">", " "),
    (0, "password=", "${DB_", "letters", 1, 8, "}", " "), (0, "token = ", "get_", "letters", 1, 6, "()", " "),
    (0, 'password: "', "********", "letters", 1, 0, "", '"'), (0, "password = ", "os.environ['", "letters", 1, 0, "", "'"),
    (0, "password: ", "", "letters", 1, 6, "", " "), (0, "secret: ", "", "letters", 3, 9, "", " "),
    (0, "tokens: ", "", "digits", 1, 8, "", " "),
    (0, "", "", "digits", 1, 16, "", " "), (0, "call ", "555-", "digits", 1, 10, "", " "),
    (0, "id ", "", "uuid", 1, 36, "", " "), (0, "commit ", "", "hex", 1, 40, "", " "),
    (0, "sha256 ", "", "hex", 1, 64, "", " "), (0, "checksum: ", "", "hex", 1, 32, "", " "),
    (0, "https://example.com/", "article/", "digits", 1, 6, "", " "), (0, "", "release-notes-version-", "digits", 1, 4, "", "."),
    (0, "see ", "docs/section", "digits", 1, 3, "/index", " "), (0, "on ", "2019-06-", "digits", 1, 8, "", " "),
    (0, "", "serviceRequest", "digits", 1, 2, "ResultList", " "), (0, "order ", "INV-", "digits", 1, 10, "", " "),
    (0, "https://cdn.example.com/static/", "", "hex", 1, 20, "/main", " "), (0, "at ", "mailserver", "digits", 1, 2, "-example", " "),
)


def labelled_findings(spark: SparkSession, per_kind: int = PER_KIND) -> DataFrame:
    """Labelled findings by rule: each of KINDS is filled with digests of its number, amid plain words."""
    def digest(salt: str) -> Column:
        return F.sha2(F.concat_ws(":", F.lit(salt), "i").cast("binary"), 256)

    names = ("label", "before", "head", "form", "begin", "size", "tail", "after")
    kinds = spark.createDataFrame(list(KINDS), "label int, before string, head string, form string, begin int, size int, "
                                               "tail string, after string")
    rows = (kinds.select(F.explode(F.sequence(F.lit(1), F.lit(per_kind))).alias("i"), *names)
            .withColumn("hex", digest("a")).withColumn("other", digest("b"))
            .withColumn("mixed", F.translate(F.base64(F.unhex(F.concat("hex", "other"))), "+/=\r\n", "xY"))
            .withColumn("digits", F.translate("other", "abcdef", "123456"))
            .withColumn("letters", F.translate("hex", "0123456789", "ghijklmnop"))
            .withColumn("signs", F.translate("mixed", "aeiouAEIOU", "!@#$%&*.?^"))
            .withColumn("uuid", F.regexp_replace(F.left("hex", F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))
            .withColumn("capitals", F.translate(F.upper("mixed"), "+/01", "QZ23"))
            .withColumn("words", F.translate(F.left("other", F.lit(24)), "0123456789", "  aeiou en")))
    value = F.coalesce(*[F.when(F.col("form") == f, F.col(f)) for f in ("hex", "mixed", "capitals", "digits", "uuid", "letters", "signs")])
    return rows.select(F.concat("words", F.lit(" "), "before").alias("before"),
                       F.concat("head", F.substring(value, F.col("begin"), F.col("size")), "tail").alias("candidate"),
                       F.concat("after", "words").alias("after"), "label")


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """A forest from labelled findings: before, candidate, after, label."""
    rows = assembler().transform(with_features(stage(findings.coalesce(1), "findings"))).select(
        "features", F.col("label").cast("double").alias("label"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=TREE_DEPTH, seed=7).fit(rows)


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def hits(docs: DataFrame, *keep: str) -> DataFrame:
    """Texts with candidates: ``keep``, ``__found`` (the candidates) and ``__between`` (what stands between them)."""
    hit = docs.select(*keep, common.text_or_empty("text").alias("__text")).filter(F.col("__text").rlike(CANDIDATE))
    return hit.select(*keep, F.regexp_extract_all("__text", F.lit(CANDIDATE), 0).alias("__found"),
                      F.split("__text", CANDIDATE).alias("__between"))


def candidates(parts: DataFrame, *keep: str) -> DataFrame:
    """One row per candidate of ``hits``: ``keep``, number, start (code points before it), before, candidate, after.

    The text between candidates comes from splitting at them, so contexts and
    places need no search of their own.
    """
    lengths = F.transform(F.arrays_zip("__found", F.slice("__between", 1, F.size("__found")).alias("gap")),
                          lambda p: F.struct(F.length(p["gap"]).alias("g"), F.length(p["__found"]).alias("c")))
    # (end of the last candidate, starts so far)
    none = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts"))
    placed = parts.withColumn("__starts", F.aggregate(lengths, none, lambda a, p: F.struct(
        (a["end"] + p["g"] + p["c"]).alias("end"), F.concat(a["starts"], F.array(a["end"] + p["g"])).alias("starts")))["starts"])
    return (placed.select(*keep, "__between", "__starts", F.posexplode("__found").alias("number", "candidate"))
            .select(*keep, "number", F.get("__starts", F.col("number")).alias("start"),
                    F.right(F.get("__between", F.col("number")), F.lit(CONTEXT)).alias("before"), "candidate",
                    F.left(F.get("__between", F.col("number") + 1), F.lit(CONTEXT)).alias("after")))


def judged(found: DataFrame, model: RandomForestClassificationModel, threshold: float = THRESHOLD) -> DataFrame:
    """Candidates with ``score`` and ``is_secret``."""
    scored = model.transform(assembler().transform(with_features(found)))
    return (scored.withColumn("score", vector_to_array("probability")[1])
            .drop("features", "rawPrediction", "probability", "prediction", *FEATURES)
            .withColumn("is_secret", F.col("score") >= threshold))


def scan(docs: DataFrame, model: RandomForestClassificationModel, *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """Candidates of all texts with ``score`` and ``is_secret``."""
    return judged(candidates(hits(docs, *keep), *keep), model, threshold)


def redact(docs: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mask, and ``n_chars`` (if there) counted anew.

    The pattern is searched once: rows are written with the candidates of their text and what stands between them, and both the
    scan and the masking start from there. Texts without candidates pass straight through. Decisions are
    a function of the text, so they are taken once for each distinct text and joined back by its digest.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = common.text_or_empty("text")
    parts = F.struct(F.regexp_extract_all(text, F.lit(CANDIDATE), 0).alias("found"), F.split(text, CANDIDATE).alias("between"))
    searched = stage(docs.select(*columns, F.when(text.rlike(CANDIDATE), parts).alias("__parts")), "searched")
    hit = searched.filter("__parts is not null").withColumn("__key", F.unhex(F.md5(text.cast("binary"))))
    distinct = hit.select("__key", "__parts").dropDuplicates(["__key"]).select(
        "__key", F.col("__parts.found").alias("__found"), F.col("__parts.between").alias("__between"))
    secrets = stage(judged(candidates(distinct, "__key"), model).filter("is_secret").groupBy("__key").agg(
        F.collect_set("number").alias("__secret")), "secrets")
    masked = F.array_join(F.transform("__parts.between", lambda p, i: F.concat(
        p, F.when(i >= F.size("__parts.found"), "").when(F.array_contains("__secret", i), MASK)
        .otherwise(F.get("__parts.found", i)))), "")
    cleaned = hit.join(secrets, "__key", "left").withColumn("text", F.when(F.col("__secret").isNull(), F.col("text")).otherwise(masked))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("__secret").isNull(), F.col("n_chars")).otherwise(counted))
    return searched.filter("__parts is null").select(*columns).unionByName(cleaned.select(*columns))


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of all documents: doc_id, number, start, length, candidate_sha256, score, is_secret."""
    model = train(labelled_findings(spark))
    return scan(common.table(spark, folder, "documents"), model, "doc_id").select(
        "doc_id", "number", "start", F.length("candidate").alias("length"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"), "score", "is_secret")


def secrets_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, secrets masked."""
    return redact(docs, train(labelled_findings(spark)))
