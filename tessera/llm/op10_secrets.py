"""Secret scans with a random forest that removes false positives.

A candidate is a bare run of at least 16 characters of ``A-Z a-z 0-9 _ + / -`` with a digit in it or the form of an access key id (and up to two ``=`` behind), or
the value that a secret name is given by ``=``, ``:``, ``:=`` or ``=>``, of any length, letters and signs, up to white space or a quote and without the punctuation at its end.
Its features are its length, shares and transitions of character classes, how much of it common words
cover, whether it looks like a path, and its neighbouring words: an assignment, quotes, a word that names a secret, a word
that names something else (a checksum, a commit, an example). A random forest trained from labelled findings gives the
probability that it is a secret.

The trained trees are written out as one SQL expression, so a scan is a projection: candidates and features are
built, scored and replaced inside their row, nothing is shuffled and no Python runs.

``labelled_findings`` makes the training set: for a bounded sample of ids, findings of known kinds whose random part is a digest of the id.

Defined results: null text counts as empty and stays null where texts are returned; texts of any length are read whole; repeated
rows give repeated rows; the empty table gives an empty one; without findings nothing is a secret. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

SAMPLE_IDS, TREES, DEPTH, SEED = 1500, 20, 6, 7
SECRET_AT = 0.5
MASK = "[SECRET]"
#: Words by which the dictionary coverage is measured.
DICTIONARY = (
    "the and ing ion ent tion for that with from this have not are you her his out our over under name file path data test user "
    "item page list index class method value string number object version image content system server client config default "
    "ung sch ich ein der die das und ver ment que les des pour dans est con para los las del ado"
).split()

_QUOTE = r"\\x22\\x27"
_NAMES = "token|secret|passw|pwd|api.?key|access.?key|auth|credential|private.?key|bearer"
_BARE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9]|A[KS]IA[A-Z]{16})[A-Za-z0-9_+/-]{16,}+={0,2}"
# the short look behind spares most positions the long one
_ASSIGNED = (
    rf"(?<=[=:>][ ]{{0,3}}[\x22\x27]?)(?<=(?i:{_NAMES})[A-Za-z0-9_-]{{0,11}}[\x22\x27]?[ ]{{0,3}}(?:[:=]|:=|=>)[ ]{{0,3}}[\x22\x27]?)"
    r"(?![=:>])[^\s\x22\x27`]*[^\s\x22\x27`.,;:!?)\]}]"
)
CANDIDATE = f"{_ASSIGNED}|{_BARE}"
_OTHERS = "sha|md5|commit|hash|checksum|uuid|guid|example|sample|dummy|revision|digest|etag|id|order|card|phone|page|url|http"
FEATURES = {
    "length": "least(length(c), 200)",
    "digits": "regexp_count(c, '[0-9]') / length(c)",
    "upper": "regexp_count(c, '[A-Z]') / length(c)",
    "not_hex": "regexp_count(c, '[^0-9a-fA-F]') / length(c)",
    "signs": "regexp_count(c, '[_+/=-]') / length(c)",
    "other_signs": "regexp_count(c, '[^A-Za-z0-9_+/=-]') / length(c)",
    "code": r"regexp_count(c, '[(\x5B{$<*%]|[A-Za-z]\x5C.[A-Za-z]') + if(after rlike '^[(\x5B]', 2, 0)",
    "vowels": "regexp_count(c, '[aeiouyAEIOUY]') / (1 + regexp_count(c, '[A-Za-z]'))",
    "letter_digit": "(regexp_count(c, '[A-Za-z](?=[0-9])') + regexp_count(c, '[0-9](?=[A-Za-z])')) / length(c)",
    "case_changes": "(regexp_count(c, '[a-z](?=[A-Z])') + regexp_count(c, '[A-Z](?=[a-z])')) / length(c)",
    "repeats": r"regexp_count(c, '(.)(?=\\1)') / length(c)",
    "distinct": "size(array_distinct(split(substring(c, 1, 200), ''))) / least(length(c), 200)",
    "covered": "1 - length(regexp_replace(lower(c), '" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + "', '')) / length(c)",
    "path": r"regexp_count(c, '/') + if(before rlike '[/.\\x5C~]$', 2, 0) + if(after rlike '^[/.][A-Za-z]', 2, 0)",
    "uuid": "if(c rlike '^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$', 1, 0)",
    "prefix": "if(c rlike '^(A[KS]IA[A-Z0-9]{16}$|gh[pousr]_|sk-|xox[abp]-|AIza|eyJ)', 1, 0)",
    "assigned": f"if(before rlike '[:=]>?[ ]{{0,3}}[{_QUOTE}]?$', 1, 0)",
    "quoted": f"if(before rlike '[{_QUOTE}`]$' and after rlike '^[{_QUOTE}`]', 1, 0)",
    "named": f"if(before rlike '(?i)({_NAMES})[^ ]{{0,12}}[ ]{{0,3}}([:=]>?|is)?[ ]{{0,3}}[{_QUOTE}]?$', 1, 0)",
    "other": rf"if(before rlike '(?i)\\b({_OTHERS})[0-9]{{0,3}}[^A-Za-z0-9]{{0,4}}([A-Za-z]{{1,12}}[^A-Za-z0-9]{{1,3}})?$', 1, 0)",
    "end_word": "if(before rlike '[A-Za-zÀ-ÿ.,] $' and after rlike '^[ .,]', 1, 0)",
}


def candidates(text: Column) -> Column:
    """Array of struct<gap, c, before, after> of a text; the last entry has no candidate, only the gap behind all of them."""
    gaps, found = F.split(text, CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    # both arrays are bound once
    both = F.array(F.struct(gaps.alias("gaps"), found.alias("found")))
    made = F.transform(
        both,
        lambda b: F.transform(
            b["gaps"],
            lambda gap, k: F.struct(
                gap.alias("gap"),
                F.get(b["found"], k).alias("c"),
                F.when(F.get(b["found"], k).isNotNull(), F.right(gap, F.lit(48))).alias("before"),
                F.when(F.get(b["found"], k).isNotNull(), F.left(F.get(b["gaps"], k + 1), F.lit(16))).alias("after"),
            ),
        ),
    )
    return F.when(text.rlike(CANDIDATE), F.get(made, F.lit(0)))


def _features(row: str) -> list[str]:
    """The feature expressions over the fields of a struct."""
    return [re.sub(r"\b(c|before|after)\b(?=[,)]| rlike)", row + r".\1", f) for f in FEATURES.values()]


def labelled_findings(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """c, before, after, label: findings of known kinds for a bounded sample of ids, with the digests of the id as their random parts."""
    ids = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id")).distinct()
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_IDS)
    h = ids.selectExpr(
        "sha2(id, 512) h", "md5(id) m", "translate(substring(base64(unhex(sha2(id, 512))), 1, 60), '=', '') b",
        "translate(sha2(concat(id, 'n'), 512), 'abcdef', '192837') d", "int(conv(substring(md5(id), 1, 4), 16, 10)) r",
    )
    names = "array('token', 'secret', 'api_key', 'API-KEY', 'password', 'passwd', 'access_key', 'auth_token', 'client_secret', 'private_key')[r % 10]"
    said = "array(' = \"', '=\"', ': ', ': \"', ' = \\'', '=', ' => \"')[r % 7]"
    closed = "array('\"', '\"', ' ', '\"', '\\'', ' ', '\"')[r % 7]"
    word = "array('rate', 'value of', 'the', 'and', 'for', 'und', 'les')[r % 7]"
    kinds = [
        (1, f"concat('lorem ', {names}, {said})", "substring(h, 1, array(16, 18, 20, 24, 32, 40, 64)[r % 7])", closed),
        (1, f"concat('set ', {names}, {said})", "substring(b, 1, 20 + r % 40)", closed),
        (1, "' '", "concat('AKIA', upper(substring(conv(substring(h, 1, 15), 16, 36), 1, 8)), upper(substring(conv(substring(h, 16, 15), 16, 36), 1, 8)))", "' '"),
        (1, f"concat({word}, ' ')", "concat('AKIA', translate(upper(substring(h, 1, 16)), '0123456789', 'GHIJKLMNOP'))", "' and'"),
        (1, f"concat('x. ', {word}, ' ')", "concat('AKIA', translate(upper(substring(h, 1, 16)), '01', 'QR'))", "'.'"),
        (1, "concat('Authorization: Bearer ')", "concat('ghp_', substring(b, 1, 36))", "' '"),
        (1, f"concat('x ', {names}, ' is ')", "substring(b, 1, 24 + r % 16)", "' now'"),
        (0, "concat('see commit ')", "substring(h, 1, 40)", "' in'"),
        (0, "concat('sha256: ')", "substring(h, 1, 64)", "' ok'"),
        (0, "concat('md5 = \"')", "m", "'\"'"),
        (0, f"concat('uuid {{', {word}, '}} ')", "concat_ws('-', substring(h, 1, 8), substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12))", "' '"),
        (0, f"concat(' id ', {word}, ' ')", "concat_ws('-', substring(h, 1, 8), substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12))", "'.'"),
        (0, f"concat({word}, ' ')", "substring(d, 1, 16 + r % 4)", "' then'"),
        (0, f"concat({word}, ': ')", "substring(d, 1, 16 + r % 4)", "' '"),
        (0, "concat('open ')", "concat('usr/lib/', array('python3', 'java17', 'node20')[r % 3], '/site-packages/', substring(m, 1, 3), '/index')", "'.html'"),
        (0, "concat('https://host.example/')", "concat('items/list_page_', r, '/', substring(d, 1, 6), '/view')", "'.html'"),
        (0, f"concat({names}, {said})", "concat('your_', array('token', 'secret', 'password')[r % 3], '_here_1234567')", closed),
        (0, f"concat({names}, {said})", "repeat(array('x1', '0', '12345', 'abc1')[r % 4], 8)", f"concat('00', {closed})"),
        (0, "concat('def ')", "concat('test_default_value_of_', array('user', 'page', 'item')[r % 3], '_', r)", "'('"),
        (0, "concat('class ')", "concat('DefaultConfigVersion', r, 'ServerClient')", "' {'"),
        (0, f"concat({word}, ' ')", "concat('tionereshinganden', r % 10, 'thering')", "' a'"),
        (0, f"upper(concat({word}, ' '))", "concat('TIONSHERINGER', array('THEREDED', 'ENTION', 'ANDTHEN')[r % 3], r % 10)", "' IN'"),
        (0, "array('', ' ')[r % 2]", "concat('THERED', array('SHANING', 'UNGER', 'SCHENAND')[r % 3], array('THEREDED', 'ENTION')[r % 2], r % 10)", "' IN'"),
    ]
    short = [  # values of secret names: of any length, with signs or of letters alone
        (1, "substring(b, 1, 8 + r % 9)"),
        (1, "concat(substring(b, 1, 3 + r % 5), array('!', '.', '$', '#', '@', '%', '&', '?')[r % 8], substring(b, 20, 4 + r % 7), array('', '-', '!x', '.2')[r % 4])"),
        (1, f"concat(array('s3cr3t', 'Pa55w0rd', 'p4ssw0rd', 'h3ll0', 'Wint3r', 'm0nk3y')[r % 6], array('!', '.', '@', '#')[r % 4], {word}, array('.', '!', '-')[r % 3], r)"),
        (1, "substring(translate(b, '0123456789+/', 'qWxZkVjQzXpR'), 1, 10 + r % 20)"),
        (1, "substring(translate(h, '0123456789', 'ghjkmqrtvz'), 1, 12 + r % 12)"),
        (1, "substring(translate(m, '0123456789', 'GhJkMqRtVz'), 1, 9 + r % 6)"),
        (1, "concat(substring(d, 1, 6 + r % 5), substring(b, 1, 3))"),
        (0, f"{word}"),
        (0, "array('required', 'None', 'null', 'true', 'false', 'string', 'password', 'invalid', 'expired', 'optional', 'Smith', 'unknown', 'hidden', 'basic', 'Maria')[r % 15]"),
        (0, "concat(array('the', 'ention', 'hered', 'sion', 'unger', 'ninger')[r % 6], array('ing', 'ion', 'ther', 'and', 'ein', 'schen')[r div 6 % 6], array('', 's', 'ent')[r % 3])"),
        (0, "concat(array('get', 'read', 'load', 'input', 'env')[r % 5], array('Token', 'Secret', 'Password', '_value')[r % 4], array('()', '(user)', '(name', '[0]')[r div 4 % 4])"),
        (0, "concat(array('os.environ', 'config.get', 'settings', 'self.user', 'request.form')[r % 5], array('.token', '.password', '[', '(key)', '.value')[r div 5 % 5])"),
        (0, "concat(array('${', '<', '{{', '%(')[r % 4], array('TOKEN', 'your-secret', 'password', 'API_KEY')[r div 4 % 4], array('}', '>', '}}', ')s')[r % 4])"),
        (0, "repeat(array('*', 'x', '.', '-', '#')[r % 5], 4 + r % 12)"),
        (0, "concat(array('my_', 'your_', 'user_', 'the-')[r % 4], array('token', 'secret', 'password', 'name')[r div 4 % 4], array('', '_here', '-file', '_value')[r % 4])"),
        (0, "cast(r % 1000 as string)"),
        (0, "concat('https://host.example/', array('login', 'token', 'list')[r % 3])"),
    ]
    tail = r"'[.,;:!?)\\x5D}]*$'"  # punctuation at the end of a value stands behind it
    kinds += [(y, f"concat('lorem ', {names}, {said})", f"regexp_replace({c}, {tail}, '')", f"concat(regexp_extract({c}, {tail}, 0), {closed})") for y, c in short]
    rows = [f"named_struct('label', {y}, 'before', {before}, 'c', {c}, 'after', {after})" for y, before, c, after in kinds]
    return h.selectExpr(f"inline(array({', '.join(rows)}))").select("c", "before", "after", "label").filter(F.array_contains(F.regexp_extract_all(F.concat("before", "c", "after"), F.lit(CANDIDATE), F.lit(0)), F.col("c")))


def train(findings: DataFrame):
    """Random forest over the features of labelled findings (c, before, after, label); None without both labels."""
    # read many times in training: kept once
    rows = checkpoint(findings.selectExpr("double(label) label", *(f"double({f}) {n}" for n, f in FEATURES.items())).orderBy("label", *FEATURES).coalesce(1))
    if rows.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird").fit(vectors)


def forest_sql(model, features: str = "f") -> str:
    """SQL of the probability that a model gives the array ``features``."""

    def node(n) -> str:
        if n.subtreeDepth() == 0:
            stats = list(n.impurityStats().stats())
            return f"{stats[1] / sum(stats)!r}D"
        split = n.split()
        return f"if({features}[{split.featureIndex()}] <= {split.threshold()!r}D, {node(n.leftChild())}, {node(n.rightChild())})"

    if model is None:
        return "0D"
    return "(" + " + ".join(node(t._java_obj.rootNode()) for t in model.trees) + f") / {len(model.trees)}D"


def scan(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """docs with ``scan__``: array of struct<gap, c, score>, null for texts without a candidate; the last entry is the rest of the text."""
    score = forest_sql(model)
    with_f = ", ".join(f"double({f})" for f in _features("x"))
    rows = docs.withColumn("scan__", candidates(F.col(text).cast("string")))
    rows = rows.withColumn("scan__", F.expr(f"transform(scan__, x -> named_struct('gap', x.gap, 'c', x.c, 'f', if(x.c is null, cast(null as array<double>), array({with_f}))))"))
    score = score.replace("f[", "x.f[")
    return rows.withColumn("scan__", F.expr(f"transform(scan__, x -> named_struct('gap', x.gap, 'c', x.c, 'score', if(x.c is null, 0D, {score})))"))


def redacted(at: float = SECRET_AT) -> Column:
    """Text of a scan with its secrets replaced by ``MASK``; null where there is no candidate."""
    return F.expr(f"array_join(transform(scan__, x -> concat(x.gap, if(x.score >= {at}D, '{MASK}', coalesce(x.c, '')))), '')")


def report(docs: DataFrame, model, at: float = SECRET_AT) -> DataFrame:
    """doc_id, numbers of candidates and secrets, ``spans`` (start:end, joined by commas) and the digest of the redacted text."""
    rows = scan(docs.select("doc_id", docs["text"].cast("string").alias("text")), model)
    rows = rows.withColumn("secret__", F.expr(f"filter(sequence(0, size(scan__) - 1), k -> scan__[k].score >= {at}D)"))
    # lengths before an entry: whole blocks of 64 entries, then the entries of its own block
    rows = rows.withColumn("lens__", F.expr("transform(scan__, x -> length(x.gap) + coalesce(length(x.c), 0))"))
    rows = rows.withColumn("sums__", F.expr("transform(sequence(0, size(lens__) div 64), b -> aggregate(slice(lens__, b * 64 + 1, 64), 0, (a, n) -> a + n))"))
    start = "aggregate(slice(sums__, 1, k div 64), 0, (a, n) -> a + n) + aggregate(slice(lens__, k div 64 * 64 + 1, k % 64), 0, (a, n) -> a + n) + length(scan__[k].gap)"
    rows = rows.withColumn("spans", F.expr(f"array_join(transform(secret__, k -> transform(array(int({start})), s -> concat(s, ':', s + length(scan__[k].c)))[0]), ',')"))
    return rows.select(
        "doc_id", F.expr("coalesce(size(scan__) - 1, 0)").cast("long").alias("n_candidates"), F.expr("coalesce(size(secret__), 0)").cast("long").alias("n_secrets"),
        F.coalesce("spans", F.lit("")).alias("spans"), F.sha2(F.coalesce(redacted(at), "text", F.lit("")).cast("binary"), 256).alias("redacted_sha256"),
    )


def redact(docs: DataFrame, model, at: float = SECRET_AT) -> DataFrame:
    """docs with the secrets in ``text`` replaced; ``n_chars`` follows where the column is there."""
    rows = scan(docs, model).withColumn("text", F.coalesce(redacted(at), F.col("text").cast("string")))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rows
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
