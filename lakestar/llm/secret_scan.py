"""Secret scanning with a random forest, in DataFrame operations only.

Candidates are runs of 16 or more characters of keys and tokens, and the values
of any length and alphabet that a secret's name (token, password, ...) is set
to, in quotes or up to the next white space, quote, comma or semicolon.  A
forest over their length, character classes and transitions, dictionary
coverage, path marks and neighbouring words removes the false ones.

It is trained from labelled findings: given ones, or *planted* ones, whose
label is known because they were made as secrets or as harmless values
(checksums, identifiers, placeholders, paths, words, numbers) and set into
contexts taken from the corpus.  No label is derived from a feature, so the
forest has to weigh value and neighbourhood against each other.  Training takes
a bounded sample (``max_findings`` of each label, contexts of
``PLANTED_TEXTS`` texts); every candidate is scored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
CONTEXT = 48                    # characters kept on either side
MAX_FINDINGS = 5_000            # labelled findings of either label, at most
PLANTED_TEXTS = 300             # texts whose words surround the planted findings, at most

# Frequent letter triples of English, French, German and Spanish.
TRIPLES = ("the and ing ion tio ent ati for her ter hat tha ere ate his con res ver all ons nce men ith ted ers pro "
           "thi wit are ess not ive was ect rea com eve per int est sta cti ica ist ear ain one our iti rat "
           "les que des eur ais ait our eme ans ien dan sch ich ein und der die cht den ung gen che ine nde "
           "los las del que ado aci nte est par ara ien con").split()
SECRET_WORDS = r"(?i)(?:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)"
HARMLESS_WORDS = r"(?i)(?:commit|checksum|digest|hash|sha\d*|md5|uuid|guid|etag|example|sample|dummy|placeholder)"
SETS = r"[\"']?\s*(?::=|=>|[:=])\s*"
ASSIGNED = SETS + r"[\"'`]?$"
NAMED = SECRET_WORDS + r"(?-i)\w*" + SETS
CANDIDATE = NAMED + r"(?:\"[^\"\n]+|'[^'\n]+|`[^`\n]+|[^\s\"'`,;]+)|" + RUN

FEATURES = ["length", "digits", "uppers", "letters", "symbols", "distinct", "transitions", "hex", "covered",
            "slashes", "path_before", "secret_word", "harmless_word", "assigned", "quoted"]


def candidates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, number`` (of the candidate in its text, from 1),
    ``candidate, before, after``."""
    body = F.col(text)
    found = documents.where(body.rlike(CANDIDATE)).select(
        F.col(doc_id).alias("doc_id"), F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.split(body, CANDIDATE).alias("between"))

    def of(i):
        whole = F.element_at("found", i)
        # a value's name and quote belong to what stands before it
        name = F.regexp_extract(whole, "^(?:" + NAMED + r"[\"'`]?)", 0)
        return F.struct(i.alias("number"), F.substring(whole, F.length(name) + 1, F.length(whole)).alias("candidate"),
                        F.right(F.concat(F.element_at("between", i), name), F.lit(CONTEXT)).alias("before"),
                        F.left(F.element_at("between", i + 1), F.lit(CONTEXT)).alias("after"))

    return found.select("doc_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("found")), of)).alias("c")) \
        .select("doc_id", "c.*")


def _share(column, pattern):
    return F.length(F.regexp_replace(column, pattern, "")) / F.length(column)


def features(found: DataFrame) -> DataFrame:
    """Adds the columns of ``FEATURES``, all double."""
    c, low = F.col("candidate"), F.lower("candidate")
    change = r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    values = {
        "length": F.length(c), "digits": _share(c, "[^0-9]"), "uppers": _share(c, "[^A-Z]"),
        "letters": _share(c, "[^A-Za-z]"), "symbols": _share(c, "[A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(low, ""))) / F.least(F.length(c), F.lit(36)),
        "transitions": (F.size(F.split(c, change)) - 1) / F.length(c),
        "hex": low.rlike("^[0-9a-f]+$").cast("int"),
        "covered": 1 - F.length(F.regexp_replace(low, "|".join(dict.fromkeys(TRIPLES)), "")) / F.length(c),
        "slashes": F.length(F.regexp_replace(c, "[^/]", "")),
        "path_before": F.col("before").rlike(r"(?:[/\\@.~]|://\S*)$").cast("int"),
        "secret_word": F.col("before").rlike(SECRET_WORDS + r"\w*\W{0,6}$").cast("int"),
        "harmless_word": F.col("before").rlike(HARMLESS_WORDS + r"\W{0,6}$").cast("int"),
        "assigned": F.col("before").rlike(ASSIGNED).cast("int"),
        "quoted": (F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")).cast("int"),
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()})


def planted(documents: DataFrame, text: str = "text", texts: int = PLANTED_TEXTS) -> DataFrame:
    """Labelled findings ``candidate, before, after, label``: every template of
    ``_templates`` in the words of up to ``texts`` different texts, those with
    the smallest hashes."""
    body, h = F.col(text), F.xxhash64(text).alias("h")
    chosen = documents.where(F.length(body) > 0).select(h).distinct().orderBy("h").limit(texts)
    # one row for each hash; bounded by texts, so broadcast
    rows = documents.select(body.alias("text"), h).join(F.broadcast(chosen), "h") \
        .groupBy("h").agg(F.min(F.left("text", F.lit(400))).alias("text"))
    words = F.split(F.regexp_replace("text", r"[\s\"'`,;:=]+", " "), " ")
    rows = rows.withColumns({"words": F.filter(words, lambda w: F.length(w) > 2), "r": F.sha2(F.col("h").cast("string"), 512)}) \
        .withColumn("words", F.when(F.size("words") > 0, F.col("words")).otherwise(F.array(F.lit("text"))))
    each = rows.select("words", "r", F.posexplode(F.array(*_templates()))) \
        .select("words", "r", "pos", "col.*")
    near = F.concat_ws(" ", F.slice("words", 1 + F.pmod("pos", F.lit(5)), 5))
    return each.select(F.col("value").alias("candidate"), F.right(F.concat(near, F.lit(" "), F.col("lead")), F.lit(CONTEXT)).alias("before"),
                       F.left(F.concat("tail", F.lit(" "), near), F.lit(CONTEXT)).alias("after"), "label") \
        .where("candidate <> ''")


def _templates() -> list:
    """Structs ``label, lead, value, tail`` over ``words`` and the random hex
    digits ``r`` of a text."""
    r, upper = F.col("r"), F.upper("r")

    def word(i):
        return F.element_at("words", 1 + F.pmod(F.conv(F.substring(r, 3 * i + 1, 6), 16, 10).cast("int"), F.size("words")))

    def b64(at, n):
        return F.substring(F.base64(F.unhex(F.substring(r, at, 96))), 1, n)

    uuid = F.regexp_replace(F.substring(r, 9, 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    mixed = F.concat(b64(5, 7), F.element_at(F.array(*map(F.lit, "!#$@%.&*")), 1 + F.pmod(F.length(word(1)), F.lit(8))),
                     F.substring(upper, 40, 4))
    number = F.substring(F.translate(r, "abcdef", "274915"), 1, 16)
    secrets = [('token = "', F.substring(r, 1, 40), '"'), ("token: ", F.substring(r, 11, 32), ""), ("api_key: '", b64(3, 32), "'"),
               ('API_KEY="', F.substring(upper, 21, 24), '"'), ("secret: \"", mixed, '"'), ("password = '", mixed, "'"),
               ("password: ", F.concat(F.lower(word(2)), F.substring(r, 60, 2), F.lit("!")), ""),
               ('passwd = "', F.concat(word(3), F.substring(number, 1, 3)), '"'), ("pwd=", F.substring(r, 70, 9), ""),
               ("Authorization: Bearer ", b64(9, 40), ""), ("access_key = \"", F.concat(F.lit("AKIA"), F.substring(upper, 31, 16)), '"'),
               ('private_key => "', b64(1, 60), '"'), ("auth_token: \"", F.concat(F.lit("ghp_"), b64(7, 36)), '"'),
               ("secret_key = '", F.concat(F.substring(r, 51, 20), F.lit("-"), F.substring(r, 81, 20)), "'")]
    harmless = [("commit ", F.substring(r, 1, 40), ""), ("checksum: ", F.substring(r, 5, 64), ""), ("md5 = ", F.substring(r, 9, 32), ""),
                ("etag: \"", F.substring(r, 13, 32), '"'), ("sha1 ", F.substring(r, 17, 40), ""), ("id ", uuid, ""), ("uuid: ", uuid, ""),
                ("", F.concat(word(1), word(2), word(3), word(4)), ""), ("", F.concat(F.lower(word(5)), F.lit("_"), F.lower(word(6)), F.lit("_"), F.lower(word(7))), ""),
                ("see /", F.concat_ws("/", F.lit("usr"), word(1), word(2), word(3)), ""), ("https://", F.concat_ws("/", word(4), word(5), word(6), word(7)), ""),
                ("card ", number, ""), ("", F.concat(number, F.substring(number, 3, 4)), ""),
                ('token = "', F.concat(F.lit("your-"), F.lower(word(2)), F.lit("-token-here")), '"'), ("password: ", F.lit("changeme"), ""),
                ("password = '", F.lit("********"), "'"), ('api_key: "', F.lit("xxxxxxxxxxxxxxxx"), '"'), ("secret: ", F.lit("null"), ""),
                ("token = ", F.concat(F.lit("get_"), F.lower(word(3)), F.lit("_token()")), ""), ("password: ", F.concat(F.lit("<"), word(1), F.lit(">")), ""),
                ("secret = ", F.concat(F.lit("config."), F.lower(word(1)), F.lit(".secret")), ""), ("token: ", F.concat(F.lit("${"), F.upper(word(2)), F.lit("_TOKEN}")), ""),
                ("passwords: ", F.lower(word(6)), ""), ("authors: ", word(7), "")]
    return [F.struct(F.lit(label).alias("label"), F.lit(lead).alias("lead"), value.alias("value"), F.lit(tail).alias("tail"))
            for label, group in ((1, secrets), (0, harmless)) for lead, value, tail in group]


def by_pattern(described: DataFrame):
    """What the pattern alone would say: a value set to a secret's name."""
    return (F.col("secret_word") == 1) & (F.col("assigned") == 1)


def train(labelled: DataFrame, max_findings: int = MAX_FINDINGS, trees: int = 30, depth: int = 6, seed: int = 7
          ) -> RandomForestClassificationModel | None:
    """Forest of findings with ``FEATURES`` and ``label`` (0 or 1; others are
    left out); of each label those with the smallest hashes, equal findings
    once.  None unless both labels occur."""
    sides = [labelled.where(F.col("label") == y).select(*FEATURES, F.col("label").cast("double").alias("label"),
                                                        F.xxhash64("candidate", "before", "after").alias("_h"))
             .dropDuplicates(["_h"]).orderBy("_h", *FEATURES).limit(max_findings) for y in (0, 1)]
    sample = sides[0].unionByName(sides[1]).drop("_h").checkpoint()
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=64).fit(rows)


def judge(described: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Adds ``score``: the forest's probability of a secret."""
    if forest is None:
        return described.withColumn("score", by_pattern(described).cast("double"))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described)
    return forest.transform(rows).withColumn("score", vector_to_array("probability")[1])


def scan(documents: DataFrame, findings: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
         threshold: float = 0.5) -> DataFrame:
    """Every candidate with ``doc_id, number, candidate, score, secret``.

    A string can be a candidate if it is a run of 16 or more characters of
    ``[A-Za-z0-9+/_-]`` or is set to a secret's name, whatever its length and
    alphabet.  ``findings`` are labelled findings (``candidate, before, after,
    label``); without them they are planted into words of the corpus.  If one
    of the labels is missing there is no forest, and the pattern decides alone.
    Null and empty texts have no candidates; every row of a repeated document
    is scanned.  An empty table gives an empty one.
    """
    found = features(candidates(documents, doc_id, text)).checkpoint()
    labelled = planted(documents, text) if findings is None else findings.select(
        "candidate", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"), "label") \
        .where("candidate <> ''")
    forest = train(features(labelled))
    scored = judge(found, forest)
    return scored.select("doc_id", "number", "candidate", "score", (F.col("score") >= threshold).alias("secret"))


def redact(documents: DataFrame, findings: DataFrame | None = None, mark: str = "[SECRET]",
           null_ids: bool = False) -> DataFrame:
    """All documents with their secrets replaced; n_chars, if there is such a
    column, follows the text.  Each row loses the secrets of its own text,
    whatever other rows share its id: every occurrence of a secret's characters
    in that text, also within a longer string.  Rows with a null id are left as
    they are unless ``null_ids``."""
    # what is found in a row depends on its text alone
    keyed = documents.withColumn("_text_key", F.sha2("text", 256))
    if not null_ids:
        keyed = keyed.withColumn("_text_key", F.when(F.col("doc_id").isNotNull(), F.col("_text_key")))
    secrets = scan(keyed, findings, doc_id="_text_key").where("secret and doc_id is not null").groupBy("doc_id") \
        .agg(F.array_sort(F.collect_set("candidate")).alias("_secrets")).withColumnRenamed("doc_id", "_text_key")
    # longer ones first, so none is left in part by a shorter one within it
    ordered = F.reverse(F.array_sort(F.transform("_secrets", lambda s: F.struct(F.length(s).alias("n"), s.alias("s")))))
    clean = F.aggregate(ordered, F.col("text"), lambda t, s: F.replace(t, s["s"], F.lit(mark)))
    text = F.when(F.col("_secrets").isNull(), F.col("text")).otherwise(clean)
    out = keyed.join(secrets, "_text_key", "left").withColumn("text", text)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("_secrets").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(dict(documents.dtypes)["n_chars"])))
    return out.select(*documents.columns)
