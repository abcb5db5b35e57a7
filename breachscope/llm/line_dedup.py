"""Near-duplicate lines: one occurrence of each connected group stays.

Lines are normalised (lower case, everything but letters and digits as one blank).
Equal lines are one line from there. Two lines are linked when the edit similarity of
their words reaches the threshold, and by nothing else.

Candidates follow from that. Of the distinct word pairs (neighbours) of a line, at most
two are lost with each edit, so two linked lines have a pair of words in common, and the
rarest they have in common is among the ``2 k + 1`` rarest of each line, ``k`` being the
number of edits allowed. These are its join keys. What counts as rare is an estimate,
the same one for all lines: it decides how many candidates there are, not which are linked.
Short lines, whose pairs are often common ones, have the line less one word as keys.
(Blocks of a SimHash lose links at this similarity, see the README.)

Only a key and the number of its line are shuffled. Under each key a line is compared
with the smallest line only; lines that this leaves in different components are compared
in a second step, if another line under the key is about as long. That finds the same
components as all pairs would, and a group of
thousands of variants costs its size, not its square. Bounds on lengths, on the words'
parity bits and on counts of words come before the distance; all hold for every linked
pair. Texts of lines are fetched for candidates only, and compared by their words.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope.llm.components import components
from breachscope.session import release, settle

SIMILARITY = 0.8
MIN_WORDS = 5

# Numbers of lines to compare are broadcast up to this many (8 bytes each).
BROADCAST_LINES = 1_000_000

# Letters of scripts without blanks between words, each of which is a word: Thai, Lao and
# Burmese; Khmer; kana; Chinese characters.
_UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]"

# Buckets in which word pairs are counted, and of every how many lines one is.
_BUCKET_BITS = 18
_SAMPLE = 32

# One character for each word of two lines under comparison; beyond so many different
# words two independent hashes take the place of their numbers.
_CODES = 0xD000
_NUMBERED_WORDS = 1024


def _normalised(text: Column) -> Column:
    """Lines of words: lower-cased runs of letters and digits with one blank between
    them; in scripts without blanks each letter is a word."""
    low = F.lower(text)
    wide = (F.octet_length(low) > F.char_length(low)) & F.rlike(low, F.lit(_UNSPACED))
    apart = F.when(wide, F.regexp_replace(low, _UNSPACED, " $0 ")).otherwise(low)
    return F.split(F.regexp_replace(apart, r"[^\p{L}\p{N}\n]+", " "), "\n")


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, body, pos, norm`` of every line with a word; ``body`` tells rows with
    one id apart. (The outer kind of explode: the other one is planned with filters on
    the size of the array, which make it once more.)"""
    made = docs.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode_outer(_normalised(F.col("text"))).alias("pos", "line"))
    return made.select("doc_id", "body", "pos", F.trim("line").alias("norm")).where("norm <> ''")


def _digest(norm: Column) -> Column:
    parts = (F.xxhash64(norm), F.xxhash64(F.lit(1), norm))
    return F.unhex(F.concat(*[F.lpad(F.hex(d), 16, "0") for d in parts]))


def _allowed(n: Column, similarity: float) -> Column:
    """Word edits that a line of ``n`` words may differ in."""
    return F.floor(n * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")


def _pairs(words: Column, n: Column) -> Column:
    """A number for each pair of neighbours: the length of both words in the six highest
    bits, a hash below."""
    low = F.lit((1 << 58) - 1)
    coded = F.transform(
        words,
        lambda w: F.shiftleft(F.least(F.char_length(w), F.lit(31)).cast("bigint"), 58).bitwiseOR(F.xxhash64(w).bitwiseAND(low)),
    )
    turned = lambda x: F.shiftleft(x, 21).bitwiseXOR(F.shiftrightunsigned(x.bitwiseAND(low), 37)).bitwiseAND(low)
    lengths = lambda a, b: F.shiftleft(F.shiftrightunsigned(a, 58) + F.shiftrightunsigned(b, 58), 58)
    both = lambda a, b: lengths(a, b).bitwiseOR(turned(a).bitwiseXOR(b.bitwiseAND(low)))
    return F.slice(F.zip_with(coded, F.slice(coded, F.lit(2), n), both), F.lit(1), n - 1)


def _bucket(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1)).cast("int")


def _levels(lines: DataFrame) -> Column:
    """A byte for each bucket of word pairs: how far its count in a sample of the lines
    stands out, 0 to 7. A table of fixed size."""
    some = lines.where(F.pmod(F.xxhash64("line"), F.lit(_SAMPLE)) == 0)
    some = some.select(_pairs(F.split("norm", " "), F.col("n")).alias("pairs"))
    counted = some.select(F.explode_outer("pairs").alias("p")).groupBy(_bucket(F.col("p")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    held = counted.collect()
    mean = sum(r["n"] for r in held) / (1 << _BUCKET_BITS)
    noise = mean + 4 * mean**0.5 + 1
    out = bytearray(1 << _BUCKET_BITS)
    for r in held:
        out[r["b"]] = min(max(int((r["n"] / noise)), 1).bit_length() - 1, 7)
    return F.lit(bytes(out))


def _one_edit(similarity: float) -> int:
    """The most words that a line can have if it may differ in one edit only."""
    n = 1
    while int((n + 1) * (1 - similarity) + 1e-9) <= 1:
        n += 1
    return n


def _less_one(norm: Column) -> Column:
    """A hash of the line, and of what each word leaves of it when it is taken out: two
    lines at one edit have one of these in common, and hardly any others do."""
    words = F.split(norm, " ")
    hashed = lambda line: F.xxhash64(F.lit(2), line)
    without = lambda i: F.concat(F.slice(words, F.lit(1), i - 1), F.slice(words, i + 1, F.size(words)))
    shorter = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: hashed(F.array_join(without(i), " ")))
    return F.array_distinct(F.concat(F.array(hashed(norm)), shorter))


def _keyed(lines: DataFrame, similarity: float, min_words: int) -> DataFrame:
    """``key, line``: the keys of each line that can have a partner.

    If the longer of two lines may differ in one edit only, they are found by the lines
    less one word. Else by their rarest word pairs. A shorter line must have as many of these
    as its longest partner asks of it: the pairs of words that it can lose are one less for
    each word it is shorter, so that the partner of one more word asks most."""
    n = F.col("n")
    short = _one_edit(similarity)
    least = lambda words: max(-int(-words * similarity // 1), 2)
    able = lines.where(n >= least(max(min_words, short + 1)))
    hashed = able.select("line", "n", _pairs(F.split("norm", " "), n).alias("pairs"))
    levels = _levels(able)
    level = lambda p: F.ascii(F.substring(levels, _bucket(p) + 1, F.lit(1)).cast("string")).cast("bigint")
    # Pairs that stand out come last; of the others long words first, for they are rarer.
    length = lambda p: F.shiftleft(F.lit(62) - F.shiftrightunsigned(p, 58), 54)
    ranked = lambda p: F.shiftleft(level(p), 60).bitwiseOR(length(p)).bitwiseOR(p.bitwiseAND(F.lit((1 << 54) - 1)))
    many = F.greatest(_allowed(n, similarity) * 2 + 1, _allowed(n + 1, similarity) * 2)
    keys = F.slice(F.array_distinct(F.sort_array(F.transform("pairs", ranked))), F.lit(1), many)
    few = lines.where((n >= least(min_words)) & (n <= short))
    return hashed.select("line", F.explode_outer(keys).alias("key")).unionByName(
        few.select("line", F.explode_outer(_less_one(F.col("norm"))).alias("key"))
    )


def _sketch(norm: Column) -> Column:
    """What bounds the distance of two lines, in eight numbers of 64 bits. Of the 256 bits
    ``p0`` to ``p3`` each tells whether an odd number of words have its place as their hash.
    ``c0`` to ``c3`` hold 16 counts of words by another part of the hash, 16 bits each:
    they tell lines apart that say a word many times, or have too many words for the bits."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))
    part = lambda h: F.shiftrightunsigned(h, 62)
    one = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 2).bitwiseAND(F.lit(48)).cast("int"))
    place = lambda h: F.shiftrightunsigned(h, 8).bitwiseAND(F.lit(3))
    none = F.lit(0).cast("bigint")
    start = F.struct(*[none.alias(f"{x}{i}") for x in "pc" for i in range(4)])
    step = lambda out, h: F.struct(
        *[out[f"p{i}"].bitwiseXOR(F.when(part(h) == i, bit(h)).otherwise(none)).alias(f"p{i}") for i in range(4)],
        *[(out[f"c{i}"] + F.when(place(h) == i, one(h)).otherwise(none)).alias(f"c{i}") for i in range(4)],
    )
    return F.aggregate(F.transform(F.split(norm, " "), lambda w: F.xxhash64(w)), start, step)


def _close(a: tuple[str, str], b: tuple[str, str], similarity: float, min_words: int) -> Column:
    """Whether ``(n, sketch)`` of two lines leave them a chance to be linked.

    One edit changes the number of words by one and one count by one, or it changes two
    counts by one; a bit changes with its count."""
    allowed = _allowed(F.greatest(a[0], b[0]), similarity)
    left = allowed * 2 - F.abs(F.col(a[0]) - F.col(b[0]))
    odd = [F.bit_count(F.col(a[1])[f"p{i}"].bitwiseXOR(F.col(b[1])[f"p{i}"])) for i in range(4)]
    count = lambda x, i, k: F.shiftrightunsigned(F.col(x)[f"c{i}"], 16 * k).bitwiseAND(F.lit(0xFFFF))
    apart = [F.abs(count(a[1], i, k) - count(b[1], i, k)) for i in range(4) for k in range(4)]
    return (
        (F.greatest(a[0], b[0]) >= min_words)
        & (F.abs(F.col(a[0]) - F.col(b[0])) <= allowed)
        & (odd[0] + odd[1] + odd[2] + odd[3] <= left)
        & ((F.greatest(a[0], b[0]) > 0xFFFF) | (sum(apart[1:], apart[0]) <= left))
    )


def _letters(words: Column, code) -> Column:
    """A string of one character for each word; ``code`` numbers the words."""
    letter = lambda w: F.lpad(F.hex(F.pmod(code(w), F.lit(_CODES)) + 0x100), 4, "0")
    return F.decode(F.unhex(F.array_join(F.transform(words, letter), "")), "UTF-16BE")


def _short_code(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(_CODES))


def _within(a: Column, b: Column, most: Column) -> Column:
    return F.call_function("levenshtein", a, b, most) >= 0


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose distance in word edits is at most ``(1 - similarity)`` of the longer
    line. ``texts`` has a character for each word in ``code``; hashes of the words never
    make a distance larger, so these come first. The words themselves decide."""
    sides = [texts.select(F.col("line").alias(x), F.col("n").alias(f"n_{x}"), F.col("code").alias(f"code_{x}")) for x in "ab"]
    allowed = _allowed(F.greatest("n_a", "n_b"), similarity)
    hopeful = settle(
        pairs.join(sides[0], "a").join(sides[1], "b").where(_within(F.col("code_a"), F.col("code_b"), allowed)).select("a", "b")
    )
    sides = [texts.select(F.col("line").alias(x), F.col("norm").alias(f"norm_{x}")) for x in "ab"]
    both = hopeful.join(sides[0], "a").join(sides[1], "b")
    words = [F.split(f"norm_{x}", " ") for x in "ab"]
    different = F.array_distinct(F.concat(*words))
    # Where no two words of a pair have one hash, its distance is that of the hashes.
    clear = F.size(F.array_distinct(F.transform(different, _short_code))) == F.size(different)
    both = both.select("a", "b", "norm_a", "norm_b", clear.alias("clear"))
    # Written, so that the list of words is made once for a pair and not for every word.
    unclear = settle(both.withColumn("different", F.when(~F.col("clear"), different)), compression="zstd")
    most = _allowed(F.greatest(*[F.size(w) for w in words]), similarity)
    numbered = lambda w: F.array_position(F.col("different"), w)
    hashed = lambda w: F.xxhash64(F.lit(7), w)
    exact = F.when(F.col("clear"), True).otherwise(
        F.when(F.size("different") <= _NUMBERED_WORDS, _within(*[_letters(w, numbered) for w in words], most)).otherwise(
            _within(*[_letters(w, hashed) for w in words], most)
        )
    )
    linked = settle(unclear.where(exact).select("a", "b"))
    release(hopeful, unclear)
    return linked


def _candidates(pairs: DataFrame, lines: DataFrame, similarity: float, min_words: int) -> DataFrame:
    """The linked pairs among ``pairs(a, b)``. Texts are read only of lines that length
    and sketch leave in a pair."""
    meta = [lines.select(F.col("line").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab"]
    close = _close(("n_a", "s_a"), ("n_b", "s_b"), similarity, min_words)
    hopeful = settle(pairs.join(meta[0], "a").join(meta[1], "b").where(close).select("a", "b"))
    ends = settle(hopeful.select(F.col("a").alias("line")).union(hopeful.select(F.col("b").alias("line"))).distinct())
    wanted = F.broadcast(ends) if ends.count() <= BROADCAST_LINES else ends
    # The characters are made once for a line here, however many pairs it is in.
    texts = lines.join(wanted, "line", "left_semi").select("line", "n", "norm")
    texts = settle(texts.withColumn("code", _letters(F.split("norm", " "), _short_code)), compression="zstd")
    linked = _similar(hopeful, texts, similarity)
    release(ends, texts, hopeful)
    return linked


def line_groups(
    docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS
) -> tuple[DataFrame, DataFrame]:
    """``digest, keep`` for each line that is not alone, and all occurrences of lines.

    ``keep`` is the occurrence that stays, a struct ``(doc_id, body, pos)``. ``docs``
    has the columns ``doc_id`` and ``text``."""
    if similarity < 0.75:
        raise ValueError("keys find all links from a similarity of 0.75 only")
    # Null ids sort first in a struct; here they come last.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body", "pos")
    # Made twice, here and for the final join: a table of all lines would hold the texts.
    made = _lines(docs).withColumn("digest", _digest(F.col("norm")))
    occurrences = made.drop("norm")
    lines = settle(
        made.groupBy("digest")
        .agg(F.first("norm").alias("norm"), F.min(place).alias("keep"), F.count(F.lit(1)).alias("occurs"))
        .withColumns({"n": F.size(F.split("norm", " ")), "sketch": _sketch(F.col("norm"))})
        .withColumn("line", F.monotonically_increasing_id()),
        compression="zstd",
    )

    keyed = _keyed(lines.select("line", "n", "norm"), similarity, min_words)
    listed = settle(
        keyed.withColumn("low", F.expr("min(line) OVER (PARTITION BY key)"))
        .withColumn("high", F.expr("max(line) OVER (PARTITION BY key)"))
        .where("low < high")
        .select("key", "line", "low")
    )
    stars = settle(listed.where("line > low").select(F.col("low").alias("a"), F.col("line").alias("b")).distinct())
    first = _candidates(stars, lines, similarity, min_words)
    known = settle(components(first))

    # Under each key the smallest line has been compared with all others; what is left are
    # the others among themselves. Of these a line has a chance only if the next longer or
    # the next shorter one is near enough in length.
    rest = listed.where("line > low").select("key", "line").join(lines.select("line", "n"), "line")
    if_near = lambda other: F.coalesce(
        F.abs(F.col("n") - F.col(other)) <= _allowed(F.greatest("n", other), similarity), F.lit(False)
    )
    named = settle(
        rest.join(known.select(F.col("node").alias("line"), "component"), "line", "left")
        .withColumn("component", F.coalesce("component", "line"))
        .withColumn("shorter", F.expr("lag(n) OVER (PARTITION BY key ORDER BY n)"))
        .withColumn("longer", F.expr("lead(n) OVER (PARTITION BY key ORDER BY n)"))
        .where(if_near("shorter") | if_near("longer"))
        .select("key", "line", "component")
    )
    release(listed, known)
    # Keys with the same lines need one look only; the lines are told apart by their
    # number and two order-free hashes.
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "line")).alias(f"mark_{i}") for i in range(2)]
    open_keys = settle(
        named.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("size"),
            *marks,
        )
        .where("low < high")
        .groupBy("size", "mark_0", "mark_1")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    # What bounds the distance goes into the join, so that hopeless pairs are never rows.
    left = settle(named.join(open_keys, "key").join(lines.select("line", "n", "sketch"), "line"))
    ends = [
        left.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("line", "component", "n", "sketch")])
        for x in "ab"
    ]
    across = (
        ends[0]
        .join(ends[1], "key")
        .where(
            (F.col("component_a") < F.col("component_b"))
            & _close(("n_a", "sketch_a"), ("n_b", "sketch_b"), similarity, min_words)
        )
        .select(F.least("line_a", "line_b").alias("a"), F.greatest("line_a", "line_b").alias("b"))
        .distinct()
    )
    more = settle(across.join(stars, ["a", "b"], "left_anti"))
    release(named, open_keys, left, stars)
    second = _candidates(more, lines, similarity, min_words)
    final = settle(components(first.union(second)))
    release(more, first, second)

    of_line = settle(
        lines.select("line", "digest", "keep", "occurs")
        .join(final.select(F.col("node").alias("line"), "component"), "line", "left")
        .select("digest", "keep", "occurs", F.coalesce("component", "line").alias("component"))
    )
    release(lines, final)
    of_group = settle(
        of_line.groupBy("component")
        .agg(F.min("keep").alias("keep"), F.sum("occurs").alias("group_lines"))
        .where("group_lines > 1")
    )
    groups = settle(of_line.select("digest", "component").join(of_group, "component"))
    release(of_line, of_group)
    return groups, occurrences


def deduplicate_lines(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs``, with the text shortened, and ``n_lines, n_removed``.

    Lines end at a line feed. Of each connected group of lines, within documents and
    across them, the occurrence in the document with the smallest id stays, the first
    one there; a null id comes last. Two lines of which the longer has fewer than
    ``min_words`` words are grouped only if they are equal; lines without a letter or
    digit stay always. Rows alike in id and text are one document and keep the same
    lines. A null text stays null and has no lines; a text of which every line goes becomes empty.
    Columns by the two new names are replaced.
    """
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    groups, occurrences = line_groups(narrow, similarity, min_words)
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body", "pos")
    gone = (
        occurrences.select("digest", here.alias("here"))
        .join(groups.select("digest", "keep"), "digest")
        .where("here <> keep")
        .groupBy(F.col("here.doc_id").alias("_id"), F.col("here.body").alias("_body"))
        .agg(F.collect_set("here.pos").alias("_gone"))
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = F.split(text_col, "\n")
    all_places = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.array_except(all_places, F.col("_gone"))
    shortened = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    )
    joined = docs.select(*[F.col(f"`{c}`") for c in kept]).join(
        settle(gone),
        F.col(id_col).cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text_col)) == F.col("_body")),
        "left",
    )
    return joined.select(
        *[shortened.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("n_removed"),
    )
