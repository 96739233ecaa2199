"""Order MinHash fingerprints of documents, in SQL functions.

The k-mers are pairs of neighbouring words. Equal k-mers of a text are told apart by their
occurrence number. All are placed on one circle of hashes; from each of ``POINTS`` fixed
points on it the next ``TUPLE`` k-mers are taken, put back into their order in the text, and
hashed together. Two texts agree in a point only where the same k-mers stand there in the
same order, so the share of equal points falls with their edit distance, not only with the
words they share.

Defined results: a NULL text counts as empty. An empty text, or one of white space, has an
empty fingerprint, which is wholly like another empty one and unlike any other. A text of
one word has that word as its only k-mer. Equal texts have equal fingerprints. Texts are read
whole, up to 16,777,215 words, beyond which places would wrap. Other columns are left aside,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdgrid.llm.common import let, words_of

POINTS = 32
TUPLE = 2
# A packed number holds the hash of a k-mer above this many bits and its place below them.
PLACE_BITS = 24
HEX = 8
# Documents of this many neighbouring ids are sorted together.
BLOCK_IDS = 1024


def _packed(hashed: Column, place: Column) -> Column:
    """High bits of a hash over a place, as one number that sorts by hash first."""
    high = F.shiftleft(F.shiftrightunsigned(hashed, PLACE_BITS + 1), PLACE_BITS)
    return high.bitwiseOR(place.cast("long").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))


def _hash_part(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, PLACE_BITS)


def _kmers(words: Column) -> Column:
    """Hashes of the word pairs of a text in their order; of the word where it is alone."""

    def paired(h: Column) -> Column:
        pairs = F.transform(F.slice(h, 1, F.size(h) - 1), lambda x, i: F.xxhash64(x, F.get(h, i + 1)))
        return F.when(F.size(h) < 2, h).otherwise(pairs)

    return let(F.transform(words, lambda w: F.xxhash64(w)), paired)


def _numbered(kmers: Column) -> Column:
    """Packed numbers of the k-mers, sorted; equal k-mers differ by their occurrence.

    Sorted by hash and place, equal k-mers stand together in text order, so their
    occurrence number is the distance from the first of the run.
    """

    def runs(s: Column) -> Column:
        firsts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (_hash_part(F.get(s, i)) != _hash_part(F.get(s, i - 1))),
        )

        def renumbered(f: Column) -> Column:
            return F.flatten(
                F.transform(
                    f,
                    lambda first, r: F.transform(
                        F.slice(s, first + 1, F.coalesce(F.get(f, r + 1), F.size(s)) - first),
                        lambda x, nth: F.when(nth == 0, x).otherwise(
                            _packed(F.xxhash64(_hash_part(x), nth), x)
                        ),
                    ),
                )
            )

        repeated = let(firsts, lambda f: F.when(F.size(f) == F.size(s), s).otherwise(renumbered(f)))
        return F.sort_array(repeated)

    packed = F.sort_array(F.transform(kmers, lambda h, i: _packed(h, i)))
    return let(packed, lambda s: F.when(F.size(s) == 0, s).otherwise(runs(s)))


def _points(numbered: Column) -> Column:
    """The tuple hash of each point, over the k-mers in circle order."""
    span = 63 - PLACE_BITS
    arc = F.shiftrightunsigned  # the arc of a hash is given by its highest bits
    bits = POINTS.bit_length() - 1

    def near(s: Column) -> Column:
        # Only the first few of an arc can follow a point.
        def early(x: Column, i: Column) -> Column:
            before = F.get(s, i - TUPLE)
            return (i < TUPLE) | (arc(before, 63 - bits) != arc(x, 63 - bits))

        return F.filter(s, early)

    def hashed(c: Column) -> Column:
        def at(point: Column) -> Column:
            first = F.size(F.filter(c, lambda x: arc(x, 63 - bits) < point))
            picked = F.transform(
                F.sequence(F.lit(0), F.least(F.lit(TUPLE), F.size(c)) - 1),
                lambda t: F.get(c, ((first + t) % F.size(c)).cast("int")),
            )
            ordered = F.array_sort(
                F.transform(
                    picked,
                    lambda x: F.struct(
                        x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"),
                        _hash_part(x).alias("hash"),
                    ),
                )
            )
            return F.xxhash64(F.transform(ordered, lambda o: o["hash"]))

        return F.transform(F.array(*[F.lit(p) for p in range(POINTS)]), at)

    assert 1 << bits == POINTS and bits < span
    return let(let(numbered, near), hashed)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text: ``HEX`` hexadecimal digits for each point."""

    def written(numbered: Column) -> Column:
        digits = F.transform(_points(numbered), lambda h: F.substring(F.lpad(F.lower(F.hex(h)), 16, "0"), 1, HEX))
        return F.when(F.size(numbered) == 0, F.lit("")).otherwise(F.array_join(digits, ""))

    return let(_numbered(_kmers(words_of(text))), written)


def likeness(one: Column, two: Column) -> Column:
    """The share of points in which two fingerprints agree."""
    equal = F.size(
        F.filter(
            F.array(*[F.lit(HEX * p + 1) for p in range(POINTS)]),
            lambda at: F.substr(one, at, F.lit(HEX)) == F.substr(two, at, F.lit(HEX)),
        )
    ) / F.lit(float(POINTS))
    nothing = (one == "") | (two == "")
    return F.when(nothing, (one == two).cast("double")).otherwise(equal)


def with_next(docs: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id, text and fingerprint of every row with those of the next document.

    The next document is the one with the next smaller doc_id; after the last comes the
    first. Rows of one id follow each other by their texts; NULL ids come last.

    Ids are cut into blocks of neighbours, which one range shuffle keeps together. The
    first document of a block is also sent to the block before it, as a row that only
    serves as the next of that block's last.
    """
    block = F.floor(F.col("doc_id") / F.lit(block_ids))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # NULL ids form a block below all others.
    rows = rows.withColumn("block", F.coalesce(block, F.lit(-(1 << 62))))
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head"), F.count(F.lit(1)).alias("size"))
    every = Window.orderBy(F.col("block").desc())
    # One row per block goes through this window, about a thousandth of the documents.
    before = F.coalesce(
        F.lag("block").over(every), F.min("block").over(Window.partitionBy())
    )
    heads = heads.select("block", "head", before.alias("before"))
    # The first row of a block: of the largest id, and of its texts the largest.
    first = (
        rows.join(
            heads.withColumnRenamed("block", "own"),
            (F.col("block") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head")),
        )
        .groupBy("own", "before", "head")
        .agg(F.max("text").alias("text"))
        .select(
            F.col("head").alias("doc_id"), "text", F.col("before").alias("block"), F.lit(True).alias("guest")
        )
    )
    both = rows.withColumn("guest", F.lit(False)).unionByName(first)
    # Signed after they are dealt, so that the shuffle's range sample reads texts only.
    signed = both.repartitionByRange("block").withColumn("fingerprint", fingerprint(F.col("text")))
    order = Window.partitionBy("block").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc()
    )
    return (
        signed.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .filter(~F.col("guest"))
        .select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by as many first characters of the next."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(
        F.substr(text, F.lit(1), F.length(text) - third), F.substr(next_text, F.lit(1), third)
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and of its edited text, and how alike they are."""
    changed = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    signed = changed.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return signed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
