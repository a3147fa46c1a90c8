"""SpotSigs fingerprints: chains of content words that follow common words, in built-in functions only.

Words are runs of letters and digits, lower-cased; the common words of several languages are anchors.  Each anchor
makes one signature: itself and the next ``CHAIN`` content words, if they stand within ``REACH`` words.  The fingerprint of a text is the
sorted set of its signatures' digests of 40 bits.  A text in which no anchor has a chain takes every window of ``CHAIN`` words instead, or all
its words if there are fewer, so that only a text without words has an empty fingerprint.

With ``stretches`` this is decided word by word: a chain covers the words from its anchor to its last content word, and every window
of ``CHAIN`` words that holds a word no chain covers is a signature too.  So each word of a text is in some signature, and a stray
anchor in a text of another language, a table or a listing doesn't stand for all of it.

Signatures are kept by place, so that those of an edited text follow from the original's but for the places next to the edit.

Fingerprints are compared by Jaccard similarity.  Since that is at most the ratio of set sizes, sets are partitioned by length and
a pair is looked at only if their lengths allow the similarity asked for; see ``near_duplicates``.

Defined results: a NULL text has the fingerprint of the empty one; two empty fingerprints are alike with 1, an empty and another with 0;
rows that repeat an id are handled each for itself, ordered by text; a NULL id comes before all others; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymart.llm.tables import written

CHAIN = 2
REACH = 6

#: Common words of English, German, French and Spanish (fixed values).
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were "
    "which with you aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich im in ist mit nach nicht "
    "sich sie sind so und von vor war wie wir zu zum zur au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne "
    "nous ou par pas pour qu que qui sa se ses son sur un une vous al como con de del el ella en es esta este la las lo los más no o para pero "
    "por que se si sin su sus un una y"
).split()


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, "[^\\p{L}\\p{N}\\p{M}]+"), "")


def _digest(parts: Column) -> Column:
    """The upper 40 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(parts), 24)


def chain_places(words: Column) -> Column:
    """For each place, ``digest`` of the chain of an anchor there and the place of its ``end``; both -1 where none starts."""
    none = F.struct(F.lit(-1).cast("long").alias("digest"), F.lit(-1).alias("end"))
    # Content words with their places, NULL for anchors.
    content = F.transform(words, lambda w, i: F.when(~w.isin(*sorted(set(ANCHORS))), F.struct(w.alias("word"), i.alias("at"))))

    def chains(content: Column) -> Column:
        def chain_at(c: Column, i: Column) -> Column:
            found = _with(
                F.slice(F.array_compact(F.slice(content, i + 2, REACH)), 1, CHAIN),
                lambda chain: F.when(
                    F.size(chain) == CHAIN,
                    F.struct(
                        _digest(F.concat(F.array(F.get(words, i)), chain["word"])).alias("digest"),
                        F.element_at(chain, CHAIN)["at"].alias("end"),
                    ),
                ),
            )
            return F.coalesce(F.when(c.isNull(), found), none)

        return F.transform(content, chain_at)

    return _with(content, chains)


def window_places(words: Column, ends: Column) -> Column:
    """For each place, the digest of the window of ``CHAIN`` words there if it holds a word that no chain covers, else -1."""

    def covered(ends: Column, i: Column) -> Column:
        # A chain ends at most REACH words behind its anchor.
        found = F.get(ends, i) >= i
        for back in range(1, REACH + 1):
            found = found | (F.get(ends, i - back) >= i)
        return F.coalesce(found, F.lit(False))

    def windows(covered: Column) -> Column:
        def window_at(w: Column, i: Column) -> Column:
            full = F.get(covered, i)
            for ahead in range(1, CHAIN):
                full = full & F.coalesce(F.get(covered, i + ahead), F.lit(True))
            # Behind the last whole window none starts, but for a text shorter than that.
            starts = (i == 0) | (i <= F.size(words) - CHAIN)
            return F.when(starts & ~full, _digest(F.slice(words, i + 1, CHAIN))).otherwise(F.lit(-1).cast("long"))

        return F.transform(words, window_at)

    # The ends are taken out once, not for every word.
    marked = _with(ends, lambda ends: F.transform(words, lambda w, i: covered(ends, i)))
    return _with(marked, windows)


def placed_signatures(words: Column) -> Column:
    """``chains`` and ``windows``: for each place of a text its two signatures, -1 for none."""

    def of_words(words: Column) -> Column:
        return _with(
            chain_places(words),
            lambda chains: F.struct(chains["digest"].alias("chains"), window_places(words, chains["end"]).alias("windows")),
        )

    return _with(words, of_words)


def as_set(*placed: Column) -> Column:
    """Sorted distinct signatures of placed ones."""
    return F.sort_array(F.array_distinct(F.array_remove(F.concat(*placed), F.lit(-1).cast("long"))))


def edited_places(text: Column, other: Column, own: Column) -> Column:
    """``placed_signatures`` of ``edited(text, other)``, given those of ``text``.

    A signature depends on the ``REACH`` words before and behind its place and a word more, so those of the part that both texts begin
    with are taken over; only the words from there on are looked at.
    """
    # The last words of that part may go on in the other text, or be written in another case before it.
    same = F.size(words_of(_kept_part(text))) - 4

    def of_words(x: Column) -> Column:
        keep = F.greatest(x["same"] - 2 * REACH - CHAIN, F.lit(0))
        begin = F.greatest(keep - REACH, F.lit(0))

        def of_places(y: Column) -> Column:
            def joined(name: str) -> Column:
                return F.concat(F.slice(own[name], 1, y["keep"]), F.slice(y["placed"][name], y["keep"] - y["begin"] + 1, F.size(y["placed"][name])))

            return F.struct(joined("chains").alias("chains"), joined("windows").alias("windows"))

        tail = F.slice(x["words"], begin + 1, F.size(x["words"]))
        return _with(
            F.struct(keep.alias("keep"), begin.alias("begin"), _with(tail, placed_signatures).alias("placed")), of_places
        )

    return _with(F.struct(words_of(edited(text, other)).alias("words"), same.alias("same")), of_words)


def signatures(text: Column, stretches: bool = False) -> Column:
    """Sorted distinct signatures (40 bits each) of a text; with ``stretches`` also of the words that no chain covers."""

    def of_words(words: Column) -> Column:
        if stretches:
            return _with(placed_signatures(words), lambda placed: as_set(placed["chains"], placed["windows"]))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - CHAIN + 1))
        windows = F.transform(starts, lambda p: _digest(F.slice(words, p, CHAIN)))
        return _with(
            as_set(chain_places(words)["digest"]),
            lambda found: F.when((F.size(found) > 0) | (F.size(words) == 0), found).otherwise(as_set(windows)),
        )

    return _with(words_of(text), of_words)


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without a look at them if their lengths rule ``least`` out."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def of_common(common: Column) -> Column:
        return common / (F.size(a) + F.size(b) - common)

    exact = _with(F.size(F.array_intersect(a, b)), of_common)
    return F.when(large == 0, F.lit(1.0)).when(small < least * large, F.lit(0.0)).when(small == 0, F.lit(0.0)).otherwise(exact)


def fingerprint(signatures: Column) -> Column:
    """Ten hexadecimal digits for each signature of a set."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 10, "0")), "")


def with_next(
    docs: DataFrame, id: str = "doc_id", text: str = "text", derive: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``id``, ``text`` and ``next_text``: that of the next row by ascending id, after the last the first.

    With ``derive``, also ``derived`` and ``next_derived``: what it makes of the two texts, computed once for each row and not shuffled.  Ids
    are dealt into about ``sqrt(rows)`` buckets of equal width; each bucket is ordered by itself and has, behind its own rows, a
    copy of the first row of the next bucket.  One shuffle; only the list of buckets is ordered in one task.
    """
    docs = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    known = docs.agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).first()
    n, low, high = known["n"], known["low"] or 0, known["high"] or 0
    rows = max(256, math.isqrt(n))
    width = max(1, math.ceil((high - low + 1) * rows / max(n, 1)))
    bucket = F.coalesce(F.floor((F.col("id") - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("long")
    dealt = docs.withColumn("bucket", bucket)
    heads = dealt.groupBy("bucket").agg(F.min("id").alias("first_id"))
    order = Window.orderBy("bucket")
    # To the bucket before; the first bucket's head goes behind the last one.
    ends = heads.agg(F.max("bucket").alias("last")).first()["last"]
    targets = written(
        heads.withColumn("to", F.coalesce(F.lag("bucket").over(order), F.lit(ends).cast("long"))).select(
            F.col("first_id"), F.col("to").alias("bucket")
        )
    )
    guests = docs.join(targets, docs["id"].eqNullSafe(targets["first_id"])).select("id", "text", "bucket", F.lit(1).alias("guest"))
    together = dealt.withColumn("guest", F.lit(0)).unionByName(guests).withColumn("mixed", F.xxhash64("text"))
    place = Window.partitionBy("bucket").orderBy("guest", "id", "mixed", "text")
    rows = together.withColumn("next_text", F.lead("text").over(place))
    if derive:
        # Behind the shuffle, where the rows already lie in this order.
        rows = rows.withColumn("derived", derive(F.col("text"))).withColumn("next_derived", F.lead("derived").over(place))
    return rows.filter("guest = 0").select(
        F.col("id").alias(id), F.col("text").alias(text), "next_text", *(["derived", "next_derived"] if derive else [])
    )


def _kept_part(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - F.floor(F.length(text) / 4).cast("int"))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last quarter replaced by as many characters from the start of ``other``."""
    text, other = F.coalesce(text, F.lit("")), F.coalesce(other, F.lit(""))
    return F.concat(_kept_part(text), F.substring(other, F.lit(1), F.floor(F.length(text) / 4).cast("int")))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.8, stretches: bool = False
) -> DataFrame:
    """Pairs (``a``, ``b``, ``similarity``) of different signature sets, each set named by the smallest id that has it.

    Sets are partitioned by length: two sets of similarity ``least`` lie in the same or in neighbouring bands of ratio
    ``least``.  Within a band they meet in their rarest signatures: two sets that similar share one among the first
    ``size - ceil(least * size) + 1`` in the order of frequency.  Equal sets count once, so large groups of copies make no pairs.
    """
    own = docs.select(F.col(f"`{id}`").alias("id"), F.explode(F.array(signatures(F.col(f"`{text}`"), stretches))).alias("s"))
    sets = written(own.filter("size(s) > 0").groupBy("s").agg(F.min("id").alias("id")))
    spots = sets.select("id", F.size("s").alias("n"), F.explode("s").alias("spot"))
    common = spots.groupBy("spot").agg(F.count("*").alias("f")).filter("f > 1")
    ranked = (
        spots.join(common, "spot", "left")
        .groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "spot"))).alias("in_order"))
    )
    prefix = ranked.select(
        "id",
        "n",
        F.explode(F.expr(f"slice(in_order, 1, n - cast(ceil({least} * n) as int) + 1)")).alias("x"),
    ).filter("x.f > 1")
    band = F.floor(-F.log(F.col("n")) / F.lit(math.log(least))).cast("long")
    posted = prefix.select("id", "n", F.col("x")["spot"].alias("spot"), band.alias("band"))
    left = posted.withColumn("meet", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    right = posted.withColumnRenamed("band", "meet")
    a, b = left.alias("a"), right.alias("b")
    pairs = a.join(b, (F.col("a.spot") == F.col("b.spot")) & (F.col("a.meet") == F.col("b.meet"))).filter(
        "(a.n < b.n or (a.n = b.n and a.id < b.id)) and a.n >= %r * b.n" % least
    )
    pairs = pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    checked = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"
    )
    return (
        checked.withColumn("similarity", likeness(F.col("sa"), F.col("sb"), least))
        .filter(F.col("similarity") >= least)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
    )
