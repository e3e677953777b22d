"""Secret scans: candidates by pattern, false positives removed by a random forest; DataFrame and SQL functions and the forest of Spark's own library only.

A candidate behind a key that sounds like a secret (``KEYS``) is the whole quoted or blank-delimited value, of any length and characters. Elsewhere it is a run of at least ``SHORTEST`` letters, digits and ``+/_-`` that holds a digit, or at least 16 capitals and digits. It comes with the assignment key before it and the words beside it. The forest sees its length, its characters and the transitions between their kinds, how much of it words of a dictionary cover, its key, the neighbouring words and the path it stands in. It learns from labelled findings, by default from ``labelled_findings``: made up, without randomness, from digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty

SHORTEST = 12
RUN = "A-Za-z0-9+/_\\-"
BEFORE = r"(?:([\p{L}]{1,20}+)[,.;:]?\s+)?"
#: Groups: key, value.
STRICT = rf"(?:([A-Za-z_\-]{{2,30}}+)[\"']?\s*[=:]\s*[\"']?)?(?<![{RUN}])((?=[A-Za-z+/_\-]*[0-9])[{RUN}]{{{SHORTEST},}}|[A-Z0-9]{{16,}})(?![{RUN}])"
#: Group: word after.
AFTER = r"(?:[\"']?[,.;:]?\s+([\p{L}]{1,20})\b)?"
#: Candidates without regard to what the key says. Groups: word before, key, value, word after. The word after is read but not consumed, as it may be the next candidate's key or word before.
PATTERN = rf"{BEFORE}{STRICT}(?={AFTER})"
KEYS = r"(?i)(passw(or)?d|pwd|secret|token|api_?key|access_?key|auth|credential|private)"
_SECRET_KEY = rf"(?=[A-Za-z_\-]{{2,30}}+[\"']?\s*[=:])(?=[A-Za-z_\-]*?(?i:{KEYS.removeprefix('(?i)').replace('(', '(?:')}))"
#: Groups: key, value in double quotes, in single quotes, without quotes. One without quotes ends at a blank, less one quote and one of ``,.;:``, or where the next such key begins.
KEYED = (
    rf"{_SECRET_KEY}([A-Za-z_\-]{{2,30}}+)[\"']?\s*[=:]{{1,2}}+>?+"
    r"(?:\s*+\"([^\"\\\r\n]*+(?:\\.[^\"\\\r\n]*+){0,200}+)(?<!\")(?=\")|\s*+'([^'\\\r\n]*+(?:\\.[^'\\\r\n]*+){0,200}+)(?<!')(?=')"
    rf"|[^\S\r\n]*+[\"']?+(?!{_SECRET_KEY})([^\s\"']\S*?)(?=[\"']?[,.;:]?(?:\s|$)|[&;,?]{_SECRET_KEY}))"
)
#: Groups: word before, the four of ``KEYED``, the two of ``STRICT``.
SPAN = rf"{BEFORE}(?:{KEYED}|{STRICT})"
DICTIONARY = r"(?i)(example|sample|test|dummy|fake|changeme|change|your|here|password|passwd|secret|token|key|default|insert|placeholder|abcdef|abc|qwerty|1234567890|0123456789|123456|xxx+|000+|admin|user|order|version|release|build|invoice|page|item|file|image|index)"
TECHNICAL = r"(?i)^(commit|sha|sha1|sha256|md5|checksum|digest|hash|uuid|revision|etag|order|invoice|version|isbn|serial|tracking|card|phone)$"
PLAIN_PATH = r"(?i)(test|example|sample|fixture|mock|docs?/|readme)"
TREES, DEPTH, SEED = 24, 8, 11
FEATURES = ("length", "digits", "capitals", "smalls", "signs", "hex", "distinct", "turns", "case_turns", "covered", "is_key", "has_key", "known_prefix", "technical", "after_technical", "plain_path", "only_digits", "uuid", "longest_letters", "others")


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, path, ordinal (from 0 in its document), before, key, value, after."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), path.alias("path"), text_or_empty(text_col).alias("text"))
    # Group 1 is a whole match with the word after it and what lookaheads need to end it there again; the rest of the pattern consumes the match alone.
    found = rows.select("doc_id", "path", F.posexplode(F.regexp_extract_all("text", F.lit(rf"(?=({SPAN}{AFTER}\S{{0,64}}\s*[=:]?)){SPAN}"), F.lit(1))).alias("ordinal", "match"))
    group = lambda *at: F.concat(*[F.regexp_extract("match", SPAN + AFTER, i) for i in at])
    return found.select("doc_id", "path", "ordinal", group(1).alias("before"), group(2, 6).alias("key"), group(3, 4, 5, 7).alias("value"), group(8).alias("after"))


def _share(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(kind)) / F.greatest(F.length(text), F.lit(1))


def with_features(found: DataFrame) -> DataFrame:
    """The candidates with the forest's inputs, all doubles."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1))
    flag = lambda c: c.cast("double")
    columns = {
        "length": F.length("value").cast("double"),
        "digits": _share(v, "[0-9]"),
        "capitals": _share(v, "[A-Z]"),
        "smalls": _share(v, "[a-z]"),
        "signs": _share(v, r"[+/_\-]"),
        "hex": _share(v, "[0-9a-f]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(36)),
        "turns": F.regexp_count(v, F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")) / n,
        "case_turns": F.regexp_count(v, F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / n,
        "covered": 1 - F.length(F.regexp_replace(v, DICTIONARY, "")) / n,
        "is_key": flag(F.col("key").rlike(KEYS)),
        "has_key": flag(F.col("key") != ""),
        "known_prefix": flag(v.rlike("^(AKIA[A-Z0-9]{16}$|ASIA[A-Z0-9]{16}$|gh[pousr]_|sk_live_|xox[abp]-|AIza)")),
        "technical": flag(F.col("before").rlike(TECHNICAL) | F.col("key").rlike(TECHNICAL)),
        "after_technical": flag(F.col("after").rlike(TECHNICAL)),
        "plain_path": flag(F.col("path").rlike(PLAIN_PATH)),
        "only_digits": flag(v.rlike(r"^[0-9\-]+$")),
        "uuid": flag(v.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")),
        "longest_letters": F.array_max(F.transform(F.split(v, "[^A-Za-z]+"), F.length)) / n,
        "others": _share(v, rf"[^{RUN}]"),
    }
    return found.withColumns({f"f_{k}": F.coalesce(columns[k].cast("double"), F.lit(0.0)) for k in FEATURES})


def labelled_findings(spark: SparkSession, n: int = 6000) -> DataFrame:
    """Labelled findings made up from digests: path, before, key, value, after, label (1: a secret)."""
    rows = spark.range(n).withColumn("h", F.sha2(F.col("id").cast("string"), 256)).withColumn("g", F.md5(F.concat(F.lit("g"), F.col("id")).cast("binary")))
    h, g, i = F.col("h"), F.col("g"), F.col("id")
    upper = F.translate(F.upper(F.substring(F.base64(F.unhex(h)), 1, 40)), "+/=018", "QWEZRT")
    mixed = F.translate(F.base64(F.unhex(h)), "+/=", "xYz")
    pick = lambda words, salt: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(words))) + 1).cast("int"))
    plain = ("the", "of", "and", "der", "les", "con", "a", "", "in", "report")
    kinds = [
        ("password", F.substring(h, 1, 18), 1), ("token", F.substring(h, 1, 40), 1), ("", F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), 1),
        ("api_key", F.substring(mixed, 1, 32), 1), ("", F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), 1), ("secret", F.concat(F.substring(mixed, 3, 10), F.lit("9"), F.substring(mixed, 14, 9)), 1),
        ("access_key", F.substring(upper, 1, 20), 1), ("auth_token", F.concat(F.lit("sk_live_"), F.substring(mixed, 1, 24)), 1),
        ("password", F.concat(F.lit("changeme"), F.substring(F.translate(h, "abcdef", "123456"), 1, 4)), 0), ("token", F.concat(F.lit("your_token_here_"), F.pmod(i, F.lit(100))), 0), ("", F.concat(F.lit("AKIAEXAMPLEKEY"), F.lpad(F.pmod(i, F.lit(1000000)), 6, "0")), 0),
        ("", F.lpad(F.translate(h, "abcdef", "123456"), 16, "4"), 0), ("", F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), 0),
        ("commit", F.substring(h, 1, 40), 0), ("", F.concat(F.lit("order-2024-"), F.lpad(F.pmod(i, F.lit(100000)), 6, "0")), 0), ("md5", g, 0), ("api_key", F.lit("0123456789abcdef0123456789abcdef"), 0),
        ("", F.concat(pick(("release", "image", "invoice", "page"), "w"), F.lit("_"), pick(("final", "index", "build", "user"), "x"), F.pmod(i, F.lit(10000))), 0), ("page", F.lpad(F.translate(g, "abcdef", "654321"), 13, "1"), 0), ("", F.substring(h, 1, 40), 0),
        ("", F.upper(F.translate(F.substring(h, 1, 18), "0123456789", "glonrstiea")), 0),
        ("password", F.concat(F.substring(mixed, 1, 5), pick(("!", "&", "#", "$%", "?", "@"), "m"), F.substring(h, 1, 4)), 1), ("passwd", F.concat(pick(("hunter", "Tr0ub4dor", "dragon", "Sommer"), "n"), F.pmod(i, F.lit(100)), pick(("!", "&", "#", "*", "@", "."), "o"), F.substring(h, 1, 3)), 1),
        ("token", F.translate(F.substring(h, 1, 26), "0123456789", "gkmqvwxyzp"), 1), ("auth_token", F.concat_ws(".", F.substring(mixed, 1, 12), F.substring(h, 1, 20), F.substring(mixed, 14, 14)), 1),
        ("password", pick(("is", "required", "string", "None", "null", "reset", "The", "must", "forgotten"), "p"), 0), ("token", pick(("str", "${TOKEN}", "<your-token>", "getpass()", "os.environ.get", "self.token", "****", "$1", "request.token,"), "q"), 0),
        ("author", F.concat(F.upper(F.substring(F.translate(g, "0123456789", "glonrstiea"), 1, 1)), F.substring(F.translate(g, "0123456789", "glonrstiea"), 2, 6)), 0), ("secret", F.concat_ws(" ", pick(plain, "r"), pick(("of", "your", "to", "the"), "s"), pick(("success", "life", "account", "a good day"), "u")), 0),
    ]
    k = F.pmod(i, F.lit(len(kinds)))
    by = lambda at: F.element_at(F.array(*[x[at] if isinstance(x[at], Column) else F.lit(x[at]) for x in kinds]), (k + 1).cast("int"))
    technical = F.pmod(F.floor(i / len(kinds)), F.lit(3)) == 0
    return rows.select(
        F.when(F.pmod(F.xxhash64(i), F.lit(7)) == 0, F.lit("src/main")).otherwise(F.lit("src0")).alias("path"),
        F.when((by(2) == 0) & (by(0) == "") & technical, pick(("commit", "sha256", "card", "order", "uuid"), "t")).otherwise(pick(plain, "b")).alias("before"),
        by(0).alias("key"), by(1).alias("value"), pick(plain, "a").alias("after"), by(2).cast("double").alias("label"),
    )


def fit_forest(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED):
    """A random forest over labelled findings (path, before, key, value, after, label)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(with_features(findings))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features", featureSubsetStrategy="onethird").fit(rows)


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, ordinal, key, value, score (share of the forest for a secret), secret.

    A null text or path counts as empty; documents without candidates have no row; a document that repeats has its rows each time. Columns of ``docs`` other than those named are not read.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    model = fit_forest(labelled_findings(docs.sparkSession) if findings is None else findings)
    rows = with_features(candidates(docs, id_col=id_col, text_col=text_col, path_col=path_col))
    rows = model.transform(VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(rows))
    score = vector_to_array("probability")[1]
    return rows.select("doc_id", "ordinal", "key", "value", score.alias("score"), (score >= threshold).alias("secret"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all documents; values as digests, so that a report does not spread them."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "ordinal", "key", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "secret")


QUERIES = {"op8_secret_scan": op8_secret_scan}
ORACLES: dict = {}
