"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Words are runs of letters and digits, lower-cased. An anchor is one of the common words ``ANCHORS``; the chain of an
anchor is the next ``two`` content words (words that are no anchors) behind it, where further anchors between are passed
over and of a run of anchors the last one counts. The hashed chains of a text form its signature set, sorted; the fingerprint writes
them out in hexadecimal. Likeness is the Jaccard coefficient of two sets.

``near_pairs`` compares sets pruned: texts with equal sets form one class; sets are partitioned by length so that
only lengths that can reach the threshold meet; of each set only the rarest signatures are indexed, as two sets that
reach the threshold must share one of those; pairs that are left are compared in full.

All of it is DataFrame expressions. Defined results: null text counts as empty; a text without a chain takes its distinct
words (kept apart from chains), a text without words its own hash, and the empty text the empty fingerprint; two empty
fingerprints have likeness 1; copies of an id are ordered by their text; the last text's next one is the first; a single row is its own next one;
an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he in is it its of on or that the this to was were which with "
    "als auch auf aus bei das dem den der des die ein eine einer er es für hat ich im ist mit nach nicht sich sie sind und von war wie zu zum zur "
    "au aux avec ce ces dans du elle en est et il je la le les leur mais ne nous on ou par pas pour que qui sa se ses sont sur un une "
    "al como con cuando de del el era esta este fue ha hay las lo los más me mi muy no o para pero por si sin sobre su sus también todo uno y ya"
).split()
#: Rows that one range of ids aims at, and the most ranges; larger ones sort with spilling.
BUCKET_ROWS, MAX_RANGES = 1000, 4096


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def signatures(text: Column) -> Column:
    """Sorted distinct signatures (array of long) of a text that is not null."""
    return _from_words(_words(text), text)


def _from_words(words: Column, text: Column) -> Column:
    # the words are bound once, by a one-element transform, as are the places of the content words
    def of(w):
        places = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: ~F.get(w, i - 1).isin(ANCHORS))
        return F.get(F.transform(F.array(places), lambda p: chains(w, p)), F.lit(0))

    def chains(w, p):
        starts = F.filter(
            F.sequence(F.lit(0), F.size(p) - 2),
            lambda k: (F.get(p, k) > 1) & ((k == 0) | (F.get(p, k - 1) < F.get(p, k) - 1)),
        )
        found = F.transform(starts, lambda k: F.xxhash64(F.get(w, F.get(p, k) - 2), F.get(w, F.get(p, k) - 1), F.get(w, F.get(p, k + 1) - 1)))
        found = F.when(F.size(p) >= 2, found).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(found) > 0, found).otherwise(F.transform(w, lambda x: F.xxhash64(F.lit("word"), x)))

    got = F.when(F.size(words) > 0, F.get(F.transform(F.array(words), of), F.lit(0))).otherwise(
        F.when(F.length(text) > 0, F.array(F.xxhash64(F.lit("text"), text))).otherwise(F.array().cast("array<bigint>"))
    )
    return F.array_sort(F.array_distinct(F.transform(got, lambda h: F.shiftrightunsigned(h, 24))))


def fingerprint(sigs: Column) -> Column:
    """The set written out: ten hexadecimal digits for each signature."""
    return F.array_join(F.transform(sigs, lambda h: F.lpad(F.lower(F.hex(h)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sigs with next_text, next_sigs of the next document by descending id.

    Ranges of ids are sorted each on its own; each range also gets the first row of the range below it.
    """
    rows = docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    # Cuts between ranges by approximate quantiles; as many as the row count asks for
    total = rows.count()
    n = min(MAX_RANGES, max(1, total // BUCKET_ROWS))
    cuts = rows.agg(F.percentile_approx("doc_id", F.lit([k / n for k in range(1, n)]), 10 * n).alias("c")).first().c if n > 1 else []
    cuts = sorted(set(cuts or []))
    # ids without a value are the last range; number ranges from the highest id down
    below = F.array_size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c > F.col("doc_id"))) if cuts else F.lit(0)
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(below))
    head = rows.groupBy("part").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(0)), "doc_id", "text")).alias("head"))
    # one row for each range
    order = Window.partitionBy().orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = head.withColumn("to", F.coalesce(F.lag("part").over(order), F.max("part").over(whole)))
    guests = head.select("head.doc_id", "head.text", F.col("to").alias("part"), F.lit(True).alias("guest"))
    every = rows.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("sigs", signatures(F.col("text")))
    by = Window.partitionBy("part").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    every = every.withColumn("next_text", F.lead("text").over(by)).withColumn("next_sigs", F.lead("sigs").over(by))
    return every.filter(~F.col("guest")).drop("guest", "part")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last third replaced by the start of the next document)."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of classes whose likeness reaches the threshold, and the class of each document.

    A class is the documents with equal signature sets, numbered by their smallest id. Rows without an id take no part.
    """
    rows = docs.filter("doc_id is not null").select("doc_id", signatures(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("sigs"))
    members = rows.withColumn("set", F.sha2(fingerprint(F.col("sigs")).cast("binary"), 256))
    classes = members.groupBy("set").agg(F.min("doc_id").alias("class"), F.first("sigs").alias("sigs")).filter(F.size("sigs") > 0)
    postings = classes.select("class", F.size("sigs").alias("size"), F.explode("sigs").alias("sig"))
    rare = postings.groupBy("sig").agg(F.count("*").alias("docs"))
    rank = Window.partitionBy("class").orderBy("docs", "sig")
    kept = postings.join(rare, "sig").withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1)
    step = F.floor(F.log("size") / F.lit(-1.0) / F.log(F.lit(threshold)))  # lengths of one partition are within the threshold of one another
    kept = kept.filter("docs > 1").select("class", "size", "sig", step.alias("length"))
    left = kept.select("sig", F.col("class").alias("a"), F.col("size").alias("size_a"), F.explode(F.array("length", F.col("length") - 1, F.col("length") + 1)).alias("length"))
    right = kept.select("sig", "length", F.col("class").alias("b"), F.col("size").alias("size_b"))
    pairs = left.join(right, ["sig", "length"]).filter((F.col("a") < F.col("b")) & (F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b") - 1e-9))
    pairs = pairs.select("a", "b").distinct()
    sets = classes.select("class", "sigs")
    pairs = pairs.join(sets.select(F.col("class").alias("a"), F.col("sigs").alias("sa")), "a").join(sets.select(F.col("class").alias("b"), F.col("sigs").alias("sb")), "b")
    pairs = pairs.withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).filter(F.col("likeness") >= threshold).select("a", "b", "likeness")
    return pairs, members.groupBy("set").agg(F.min("doc_id").alias("class")).join(members.select("set", "doc_id"), "set").select("doc_id", "class")
