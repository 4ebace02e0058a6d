"""Secret scanning with a random forest that removes false positives; DataFrame functions only.

Candidates are runs of at least ``SHORTEST`` key characters and, of any length and alphabet, whatever is assigned to a telling
name (``NAME=value``, ``name: "a value"``, ``?name=value``): up to the closing quote, else up to a space, quote, ``<`` or the next
``&name=``, without signs that end a clause. A text is split at its candidates once, which gives each one's
place and its neighbourhood. Features: length, character classes and transitions between them, entropy, share covered by
dictionary words (the ``DICTIONARY`` commonest words of all documents), whether it stands in a path or address, and the
words and signs beside it. A forest is trained on labelled findings and scores every candidate.

Labels are a table (id, start, label) of reviewed findings. Without one, ``PLANTED`` made-up secrets and look-alikes are put
into stretches of the documents; what they are is known from the making, not from any feature. Training takes at most
``SAMPLE`` labelled findings, chosen by a hash, in one partition, so that it is reproducible; scanning, the dictionary and
scoring cover all rows. Results carry a SHA-256 of the secret, not the secret.

Defined cases: null and empty texts have no findings; with labels of one kind only, every finding has that label's score; an
empty table gives an empty result; equal candidates are findings of their own wherever they stand; a null id is kept
as null; repeated rows are scanned each; other columns do not matter. Places count characters from 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import settled

SHORTEST, NEAR = 16, 60
DICTIONARY, SAMPLE = 300, 20_000
#: Findings that are made up to learn from, and documents whose beginnings they are put into.
PLANTED, CONTEXTS = 6_000, 200
TREES, DEPTH, SEED = 24, 6, 7
# Names that secrets are assigned to, and words that stand beside harmless identifiers.
NAMES = "token|secret|passw|pwd|credential|api.?key|access.?key|private.?key|auth|bearer"
HARMLESS = "commit|sha1|sha256|md5|checksum|digest|uuid|revision|example|sample|dummy|placeholder"
_SIGN = r"(?:=>|:=|==|[=:])"
# The short lookbehind spares the long one at most places.
_AFTER = r"(?<=[=:>]\s{0,3}[\"'`]?)(?<=(?i:%s)[\w.-]{0,30}[\"'`]?\s{0,3}%s\s{0,3}[\"'`]?)" % (NAMES, _SIGN)
_QUOTED = "|".join(f"(?<={q})[^{q}\\n]++(?={q})" for q in "\"'`")
_BARE = r"(?:[^\s\"'`<=>&,;.)\]}]++|(?<=[^\s=:>\"'`])[=>]|[,;.)\]}](?![,;.)\]}]*+(?:[\s\"'`<]|$))|&(?![\w.-]+=))++"
_RUN = "(?:%s(?:%s|%s)|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}+)" % (_AFTER, _QUOTED, _BARE, SHORTEST)
FEATURES = [
    "length", "digits", "uppers", "hex", "distinct", "entropy", "class_changes", "vowel_changes",
    "covered", "slashes", "in_path", "named", "harmless", "assigned", "quoted",
]


def dictionary(docs: DataFrame, text: str, words: int = DICTIONARY) -> list[str]:
    """The commonest words of three to ten letters over all documents; counted before the shuffle."""
    split = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+")).alias("word"))
    counts = split.where(F.length("word").between(3, 10)).groupBy("word").count()
    return [r.word for r in counts.orderBy(F.desc("count"), "word").limit(words).collect()]


def _share(pattern: str) -> Column:
    """Share of the candidate's characters that the pattern covers."""
    return 1 - F.length(F.regexp_replace("secret", pattern, "")) / F.length("secret")


def findings(docs: DataFrame, words: list[str], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, size, sha256, features) of every candidate of every text; the work grows with the candidates' number."""
    t = F.col(text)
    runs = docs.where(t.rlike(_RUN)).select(
        F.col(doc_id).alias("id"), F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(t, F.lit(_RUN), F.lit(0)).alias("found"), F.split(t, _RUN, -1).alias("rest")
    )
    # A candidate takes along what stands close to it only, not the text's other pieces.
    beside = F.transform("found", lambda secret, i: F.struct(
        secret.alias("secret"), F.get("found", i - 1).alias("before"), F.length(F.get("rest", i)).alias("gap"),
        F.substring(F.get("rest", i), -NEAR, NEAR).alias("between"), F.substring(F.get("rest", i + 1), 1, 8).alias("right"),
    ))
    each = runs.select("id", "row", F.posexplode(beside).alias("at", "c")).select("id", "row", "at", "c.*")
    ended = F.sum(F.col("gap") + F.length("secret")).over(W.partitionBy("row").orderBy("at").rowsBetween(W.unboundedPreceding, 0))
    between = F.col("between")
    # A name long enough to be a candidate itself belongs to what is assigned to it.
    name = F.concat("before", between)
    names_it = F.coalesce((F.col("gap") <= NEAR) & between.rlike(rf"^[\"'`]?\s*{_SIGN}?\s*[\"'`]?$") & name.rlike(rf"{_SIGN}\s*[\"'`]?$"), F.lit(False))
    left = F.lower(F.substring(F.when(names_it, name).otherwise(between), -NEAR, NEAR))
    placed = each.select("id", "secret", (ended - F.length("secret")).cast("long").alias("start"), left.alias("left"), "right")
    chars = F.split(F.col("secret"), "")
    n = F.length("secret")
    share = lambda c: (n - F.length(F.replace(F.col("secret"), c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - F.when(c == "", 0.0).otherwise(share(c) * F.log2(F.greatest(share(c), F.lit(1e-9)))))
    flag = lambda c: c.cast("double")
    covered = _share("(?i)" + "|".join(sorted((w for w in words if w.isalpha()), key=lambda w: (-len(w), w)))) if words else F.lit(0.0)
    return placed.select(
        "id", "start", n.cast("long").alias("size"), F.sha2("secret", 256).alias("sha256"),
        n.cast("double").alias("length"), _share("[0-9]").alias("digits"), _share("[A-Z]").alias("uppers"),
        flag(F.col("secret").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        (F.size(F.array_distinct(chars)) / n).alias("distinct"), entropy.alias("entropy"),
        (F.regexp_count("secret", F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])")) / n).alias("class_changes"),
        (F.regexp_count(F.lower("secret"), F.lit("[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])")) / n).alias("vowel_changes"),
        covered.alias("covered"), F.regexp_count("secret", F.lit("/")).cast("double").alias("slashes"),
        flag(F.col("left").rlike(r"(?:[/\\.@]|://[^\s?#]*)$") | F.col("right").rlike(r"^(?:[/\\@]|\.[A-Za-z])")).alias("in_path"),
        flag(F.col("left").rlike(f"(?:{NAMES})")).alias("named"), flag(F.col("left").rlike(f"(?:{HARMLESS})")).alias("harmless"),
        flag(F.col("left").rlike(r"(?:=|:|=>)\s*[\"'`]?$")).alias("assigned"), flag(F.col("left").rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]")).alias("quoted"),
    )


def planted(docs: DataFrame, words: list[str], n: int = PLANTED, *, text: str = "text") -> DataFrame:
    """(id, text, start, label): ``n`` stretches of the documents with a made-up secret (1) or look-alike (0) put in.

    What is a secret is known from the making, not from features. Secrets are keys and passwords under telling names, in
    addresses, headers and free text; look-alikes are digests, identifiers, paths, compounds, numbers, and words, dates and
    placeholders under the same telling names. Stretches come from at most ``CONTEXTS`` documents, chosen by a hash.
    """
    spark = docs.sparkSession
    some = docs.where(F.length(text) > 0).select(F.substring(text, 1, 300).alias("t")).distinct()
    rows = some.orderBy(F.xxhash64("t"), "t").limit(CONTEXTS).collect()  # bounded, by both parameters
    contexts = spark.createDataFrame([(i, r.t) for i, r in enumerate(rows)] or [(0, "")], "at int, context string")
    i = F.col("id").cast("string")
    hexed = lambda salt, size: F.substring(F.concat(F.sha2(F.concat(F.lit(salt), i), 256), F.sha2(F.concat(i, F.lit(salt)), 256)), 1, size)
    mixed = lambda salt, size: F.substring(F.regexp_replace(F.base64(F.unhex(hexed(salt, 120))), "[+/=]", "x"), 1, size)
    pick = lambda salt, size: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(size)).cast("int")
    listed = F.split(F.lit(" ".join(words or ["word"])), " ")
    word = lambda salt: F.get(listed, pick(salt, len(words) or 1))
    signs = F.substring(F.lit("!%&#$*"), pick("sign", 6) + 1, F.lit(1))
    short = F.concat(F.substring(mixed("a", 9), F.lit(1), pick("size", 4) + 3), pick("digit", 10).cast("string"), F.when(pick("signed", 2) == 0, signs).otherwise(""), F.substring(mixed("b", 9), F.lit(1), pick("rest", 4) + 1))
    hidden = F.get(F.array(mixed("c", 20), mixed("c", 40), hexed("c", 32), hexed("c", 40), F.base64(F.unhex(hexed("c", 40))), F.concat(mixed("d", 12), F.lit("."), mixed("e", 20))), pick("form", 6))
    harmless = "YOUR_TOKEN_GOES_HERE your-password-here changeme xxxxxxxxxxxxxxxx placeholder_value_only none required true".split()
    plain = F.get(F.array(*map(F.lit, harmless), word("w"), F.concat_ws("-", word("x"), word("y"), word("z"))), pick("plain", len(harmless) + 2))
    values = {
        "hidden": hidden, "short": short, "plain": plain, "key": mixed("u", 20), "bearer": mixed("v", 36), "hex32": hexed("g", 32), "hex40": hexed("g", 40),
        "hex64": hexed("g", 64), "uuid": F.concat_ws("-", *[hexed(salt, size) for salt, size in zip("hijkl", (8, 4, 4, 4, 12))]), "file": mixed("o", 24),
        "compound": F.concat(F.lit("extra"), word("p"), word("q"), word("r"), word("s")), "number": F.translate(hexed("t", 24), "abcdef", "012345"),
        "time": F.lit("2024-01-01T00:00:00Z"),
    }
    secrets, likes = [], []
    for before, after in ((' = "', '"'), (": ", " "), ("=", "\n"), ("='", "'"), ('": "', '"')):
        for name in "password API_KEY token db_passwd client_secret auth_token accessKey credential".split():
            secrets += [(name + before, "hidden", after), (name + before, "short", after)]
            likes += [(name + before, "plain", after)]
    secrets += [("see https://host/x?token=", "key", "&page=2"), ("Authorization: Bearer ", "bearer", "\n")] * 8
    likes += [("commit ", "hex40", " "), ("checksum: ", "hex32", " "), ("sha256:", "hex64", " "), ("md5 = ", "hex32", " "), ("revision ", "hex40", " "), ("see ", "hex40", " "), ("digest is ", "hex64", " ")] * 3
    likes += [("id: ", "uuid", " "), ("uuid=", "uuid", " "), ("the path /usr/share/", "hex40", "/x.txt"), ("image ", "hex32", ".png"), ("from https://host/files/", "file", "/page")] * 4
    likes += [("an ", "compound", " here"), ("number ", "number", " "), ("token_expiry = ", "time", " ")] * 4
    shapes = spark.createDataFrame([(label, k, *x) for label, every in ((1, secrets), (0, likes)) for k, x in enumerate(every)], "label int, shape int, before string, kind string, after string")
    label = pick("label", 2)
    shape = F.pmod(F.xxhash64(F.lit("shape"), "id"), F.when(label == 1, len(secrets)).otherwise(len(likes))).cast("int")
    made = spark.range(n).select("id", label.alias("label"), shape.alias("shape"), F.pmod("id", F.lit(max(1, len(rows)))).cast("int").alias("at"))
    value = reduce(lambda out, x: out.when(F.col("kind") == x[0], x[1]), values.items(), F.when(F.lit(False), F.lit("")))
    head = F.concat("context", F.lit(" "), "before")
    return made.join(F.broadcast(shapes), ["label", "shape"]).join(F.broadcast(contexts), "at").select(
        "id", F.concat(head, value, "after").alias("text"), F.length(head).cast("long").alias("start"), F.col("label").cast("double").alias("label")
    )


def learned(docs: DataFrame, words: list[str], *, text: str = "text") -> DataFrame:
    """(id, label, sha256, start, features) of the planted findings: candidates at the places where something was put in."""
    made = settled(planted(docs, words, text=text))
    found = findings(made, words, doc_id="id")
    return found.join(made.select("id", "start", "label"), ["id", "start"]).select("id", "label", "sha256", "start", *FEATURES)


def scanned(docs: DataFrame, labels: DataFrame | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every candidate with ``score``, the forest's probability that it is a secret."""
    words = dictionary(docs, text)
    found = settled(findings(docs, words, doc_id=doc_id, text=text))
    if labels is None:
        known = learned(docs, words, text=text).drop("id")
    else:
        marked = labels.select(F.col(doc_id).alias("_id"), F.col("start").alias("_start"), F.col("label").cast("double").alias("label")).dropDuplicates(["_id", "_start"])
        known = found.join(marked, F.col("id").eqNullSafe(F.col("_id")) & (F.col("start") == F.col("_start"))).select("label", "sha256", "start", *FEATURES)
    model, kinds = forest(known)
    if model is None:
        return found.withColumn("score", F.lit(kinds[0] if kinds else 0.0))
    return _scored(model, found)


def forest(known: DataFrame):
    """The forest fitted on at most ``SAMPLE`` labelled findings, and the labels there are; no forest without two of them."""
    sample = known.orderBy(F.xxhash64("sha256", "start"), "sha256", "start", "label").limit(SAMPLE)
    sample = settled(sample.repartition(1).sortWithinPartitions("sha256", "start", "label", *FEATURES))
    kinds = [r.label for r in sample.select("label").distinct().collect()]  # at most two values
    if len(kinds) < 2:
        return None, kinds
    trees = RandomForestClassifier(
        labelCol="label", featuresCol="_features", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
        numTrees=TREES, maxDepth=DEPTH, seed=SEED,
    )
    return trees.fit(_assembler().transform(sample)), kinds


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features")


def _scored(model, found: DataFrame) -> DataFrame:
    return model.transform(_assembler().transform(found)).select(*found.columns, vector_to_array("_probability")[1].alias("score"))


def secrets(docs: DataFrame, labels: DataFrame | None = None, *, least: float = 0.5, **columns: str) -> DataFrame:
    """The findings that the forest keeps: (id, start, size, sha256, score)."""
    return scanned(docs, labels, **columns).where(F.col("score") >= least).select("id", "start", "size", "sha256", "score")
