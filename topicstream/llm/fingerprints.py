"""Order MinHash fingerprints of documents.

A text is a sequence of k-mers of words (long ones in pieces). A k-mer's n-th occurrence is an element of its own.
Elements are hashed and sorted; every entry of the signature takes the two smallest elements from a point of its own
in the hash range on (around the end to the beginning), puts them back into the order in which they stand in the text,
and hashes the pair. Texts share an entry if they share its elements and their order, so the share of equal entries
falls with the edit distance and not just with the overlap (after Marcais et al. 2019).

All of it is arrays inside the row. The next document's text comes by a range of ids, sorted on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topicstream.llm.common import SPACE, let, text_or_empty

TOKEN = 12  # most code points of a token
KMER = 3  # tokens
PART_BITS = 6
ENTRIES = 1 << PART_BITS
BITS = 16  # of an entry
PLACE_BITS = 26  # for a k-mer's place beside its hash: texts of up to 67 million tokens keep their order
ROWS_PER_RANGE = 256
MAX_RANGES = 20_000
_STEPS = [1 << p for p in range(30, -1, -1)]


def signature(text: Column) -> Column:
    """The text's entries as an array of ints; empty for a text of white space only."""
    tokens = F.regexp_extract_all(text, F.lit(f"[^{SPACE}]{{1,{TOKEN}}}"), F.lit(0))
    return let(tokens, lambda t: F.when(F.size(t) == 0, F.array().cast("array<int>")).otherwise(_of_tokens(t)))


def _of_tokens(tokens: Column) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - KMER, F.lit(0)))
    kmers = F.transform(starts, lambda i: _packed(F.xxhash64(*[F.get(tokens, i + j) for j in range(KMER)]), i))
    elements = let(F.sort_array(kmers), lambda ordered: F.transform(ordered, lambda x, i: _element(ordered, x, i)))
    return let(F.sort_array(elements), _entries)


def _packed(hashed: Column, place: Column) -> Column:
    """A hash's upper bits and a place in one long, which sorts several times as fast as a pair of them."""
    return hashed.bitwiseAND(-1 << PLACE_BITS).bitwiseOR(place.cast("long"))


def _hash_of(packed: Column) -> Column:
    return packed.bitwiseAND(-1 << PLACE_BITS)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND((1 << PLACE_BITS) - 1)


def _element(ordered: Column, x: Column, i: Column) -> Column:
    """The first occurrence of a k-mer as it is; another one with the number of occurrences before it in its hash."""
    same = lambda back: _hash_of(F.get(ordered, i - back)) == _hash_of(x)
    # Equal k-mers are neighbours in order: as many stand before this one as go back without a change.
    earlier = F.aggregate(
        F.array(*map(F.lit, _STEPS)), F.lit(0), lambda n, step: F.when(same(n + step), n + step).otherwise(n)
    )
    return F.when(same(F.lit(1)), _packed(F.xxhash64(_hash_of(x), earlier), _place_of(x))).otherwise(x)


def _entries(elements: Column) -> Column:
    """The hash range has a part for each entry. Only the first two elements of a part can be an entry's."""
    leading = F.filter(elements, lambda x, i: F.coalesce(_part(F.get(elements, i - 2)) != _part(x), F.lit(True)))
    return let(leading, lambda kept: let(F.transform(kept, _part), lambda parts: _of_parts(kept, parts)))


def _part(packed: Column) -> Column:
    return F.shiftright(packed, 64 - PART_BITS).cast("int")


def _of_parts(kept: Column, parts: Column) -> Column:
    n = F.size(kept)
    steps = F.array(*[F.lit(1 << p) for p in range(PART_BITS, -1, -1)])  # there are at most two elements for each part
    numbers = F.array(*[F.lit(b - ENTRIES // 2) for b in range(ENTRIES)])

    def below(b: Column) -> Column:
        return F.aggregate(
            steps, F.lit(0), lambda t, step: F.when(F.get(parts, t + step - 1) < b, t + step).otherwise(t)
        )

    def entry(b: Column) -> Column:
        # Where a part is empty, the next element is that of a later one, or around the end the first of all.
        found = F.array_position(parts, b)
        first = F.when(found > 0, (found - 1).cast("int")).otherwise(below(b))
        return let(first, lambda k: _pair(F.get(kept, k % n), F.get(kept, (k + 1) % n)))

    return F.transform(numbers, entry)


def _pair(a: Column, b: Column) -> Column:
    inside = _place_of(a) <= _place_of(b)
    first, second = F.when(inside, a).otherwise(b), F.when(inside, b).otherwise(a)
    return F.xxhash64(_hash_of(first), _hash_of(second)).bitwiseAND((1 << BITS) - 1).cast("int")


def as_text(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda x: F.lpad(F.hex(x), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; 1 for two texts without any, 0 for one."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(same / ENTRIES)


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    ``edited`` is the text with its last quarter (of code points, rounded down) replaced by as many of the next
    document's first ones, or all if it has fewer. The next document is that of the next larger id, after the last one
    the first; rows that repeat an id follow each other in the order of their texts, and rows without an id come last.
    Null counts as empty; a text of white space only has the empty fingerprint. ``near_edited`` and ``near_next`` are the
    likeness of the fingerprint to those of the edited text and of the next document. Ids are whole numbers. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("entries", signature(F.col("text")))
    following = _with_next(rows, docs.select(F.col(f"`{id_col}`").alias("doc_id")))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - quarter),
        F.substring(F.col("next.text"), F.lit(1), quarter),
    )
    changed = following.select("doc_id", "text", "entries", F.col("next.entries").alias("of_next"), edited.alias("edited"))
    changed = changed.withColumn("of_edited", signature(F.col("edited")))
    return changed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        as_text(F.col("entries")).alias("fingerprint"),
        as_text(F.col("of_edited")).alias("edited_fingerprint"),
        likeness(F.col("entries"), F.col("of_edited")).alias("near_edited"),
        likeness(F.col("entries"), F.col("of_next")).alias("near_next"),
    )


def _with_next(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with the struct ``next`` of the next row's text and entries.

    The ids are cut into ranges of a few hundred rows, each of which begins with an id that occurs. The rows with
    that id also go to the range before (those with the smallest id to the last), behind its own rows.
    """
    n = ids.count()
    ranges = min(MAX_RANGES, -(-max(1, n) // ROWS_PER_RANGE))
    shares = [k / ranges for k in range(ranges)]
    found = ids.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, max(10_000, 10 * ranges))).first()
    starts = sorted({found[0], *found[1]}) if found[0] is not None else [0]
    cuts = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(s) for s in _STEPS if s <= len(starts)])
    upto = F.aggregate(
        steps,
        F.lit(0),
        lambda t, step: F.when(
            F.coalesce(F.get(cuts, t + step - 1) <= F.col("doc_id"), F.lit(False)), t + step
        ).otherwise(t),
    )
    own = F.when(F.col("doc_id").isNull(), F.lit(len(starts) - 1)).otherwise(upto - 1)
    ranged = rows.withColumn("range", own)
    here = F.struct(F.col("range"), F.lit(False).alias("behind"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("behind"))
    leads = F.coalesce(F.get(cuts, F.col("range")) == F.col("doc_id"), F.lit(False))
    placed = ranged.withColumn("place", F.explode(F.when(leads, F.array(here, before)).otherwise(F.array(here))))
    placed = placed.select("doc_id", "text", "entries", "place.*")
    order = W.partitionBy("range").orderBy("behind", F.asc_nulls_last("doc_id"), "text")
    after = F.struct("text", "entries")
    # Without any id there is one range and nothing behind it: its first row follows its last.
    nothing_behind = F.first(after).over(order.rowsBetween(W.unboundedPreceding, 0))
    following = placed.withColumn("next", F.coalesce(F.lead(after).over(order), nothing_behind))
    return following.where("not behind").drop("range", "behind")
