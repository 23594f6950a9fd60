"""Near-duplicate lines by a segment-partition edit join.

Two lines are linked when so few single-character edits lie between them as the
shorter one allows: one for every ``PER_EDIT`` characters, ``THRESHOLD`` at most. A
line is cut into one segment more than the edits it allows; then at least one
segment of the shorter line occurs unchanged in the longer one, near its own place. So every line indexes its segments under (length,
segment number, content), and probes, for each length it could match, the few
substrings whose place still allows the remaining edits on both sides. Lines
that meet are verified by a banded bit-parallel edit distance: one column of the
band is one integer, one character of the line one step on it.

All of it is DataFrame operations. Copies of a line are folded before the join,
and substrings that no line has as a segment are filtered before the shuffle.

Defined cases: a null text has no lines; empty lines are left out; lines too short
for an edit have exact copies only; when lines are dropped, blank ones stay; null
ids sort first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flag_members, stored, text_key, union_all
from .graph import components

THRESHOLD = 2
PER_EDIT = 10
LETTERS = "aeinorsthdlu"  # counted modulo 32, five bits each, in one number


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(id, line, chars, letters, doc_id, copies): every distinct non-empty line, its smallest document and its number of places."""
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    folded = lines.groupBy("line").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    letters = F.lit(0).cast("long")
    for i, c in enumerate(LETTERS):
        # bytes: a line's own length is known then, and the letters have one each
        count = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(c)))
        letters = letters.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(31)).cast("long"), 5 * i))
    columns = [F.monotonically_increasing_id().alias("id"), "line", F.char_length("line").alias("chars"), letters.alias("letters"), "doc_id", "copies"]
    return stored(folded.select(*columns), "lines")


def letters_apart(a: Column, b: Column) -> Column:
    """A lower bound of the sum of differences between two lines' letter counts; an edit adds 2 to it at most."""
    total = F.lit(0)
    for i in range(len(LETTERS)):
        x, y = (F.shiftright(c, 5 * i).bitwiseAND(F.lit(31)).cast("int") for c in (a, b))
        total = total + F.least(F.abs(x - y), F.lit(32) - F.abs(x - y))
    return total


def allowed_edits(chars: Column) -> Column:
    """How many edits a line of so many characters allows."""
    edits = F.lit(0)
    for t in range(1, THRESHOLD + 1):
        edits = F.when(chars >= t * PER_EDIT, F.lit(t)).otherwise(edits)
    return edits


def _keys(lines: DataFrame, asked: list[tuple[int, int, int]], edits: int) -> DataFrame:
    """(key, id, chars, letters, own): a key for each (shorter by, segment, shift) asked of each line, where the line has such a
    substring and a line that much shorter allows just ``edits``. ``own``: it is one that the line is indexed under.

    A line of n characters is cut into edits + 1 segments of n // (edits + 1)
    characters, the last ones a character longer where that leaves a rest.
    """
    parts = edits + 1
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("less"), F.lit(i).alias("segment"), F.lit(x).alias("shift")) for d, i, x in asked]))
    rows = lines.where(F.col("chars") >= edits * PER_EDIT)
    if edits < THRESHOLD:
        rows = rows.where(F.col("chars") < (edits + 1) * PER_EDIT + edits)
    rows = rows.select("id", "line", "chars", "letters", each.alias("s")).select("id", "line", "chars", "letters", "s.segment", "s.shift", F.expr("chars - s.less").alias("length"))
    rows = rows.withColumn("extra", F.expr(f"segment - ({parts} - length % {parts})"))
    rows = rows.withColumn("at", F.expr(f"int(length div {parts}) * segment + greatest(extra, 0) + shift"))
    rows = rows.withColumn("size", F.expr(f"int(length div {parts}) + int(extra >= 0)"))
    rows = rows.where((allowed_edits(F.col("length")) == edits) & (F.col("at") >= 0) & (F.col("at") + F.col("size") <= F.col("chars")))
    own = (F.col("length") == F.col("chars")) & (F.col("shift") == 0)
    return rows.select(F.xxhash64("length", "segment", F.expr("substring(line, at + 1, size)")).alias("key"), "id", "chars", "letters", own.alias("own"))


def index_keys(lines: DataFrame) -> DataFrame:
    """The keys under which lines are indexed: their own segments."""
    return union_all([_keys(lines, [(0, i, 0) for i in range(t + 1)], t) for t in range(1, THRESHOLD + 1)]).drop("own")


def probe_keys(lines: DataFrame) -> DataFrame:
    """The keys that lines ask for: segments of equal or shorter lines, shifted as far as the edits left on both sides allow."""
    parts = []
    for t in range(1, THRESHOLD + 1):
        asked = []
        for less in range(t + 1):
            for i in range(t + 1):
                low, high = max(-i, less - (t - i)), min(i, less + (t - i))
                asked += [(less, i, shift) for shift in range(low, high + 1)]
        parts.append(_keys(lines, asked, t))
    return union_all(parts)


_MAPS, _WORDS = 2048, 512  # bitmaps of 512 words of 64 bits: 8 MB to broadcast, whatever the number of keys


def only_known(rows: DataFrame, key: str, known: DataFrame, own: str | None = None) -> DataFrame:
    """``rows`` without those whose ``key`` is certainly not in the one column of ``known``, by a filter of fixed size.

    Where the column ``own`` is true, the row's key is in ``known`` for the row itself:
    it goes if the key is certainly there only once. The filter lets more through the
    more keys there are; what it lets through still has to be joined.
    """

    def at(c: str) -> list[Column]:
        return [F.pmod(F.col(c), F.lit(_MAPS)).alias("_map"), F.shiftright(c, 20).bitwiseAND(F.lit(64 * _WORDS - 1)).alias("_bit")]

    # keys travel to their map's task, not a bitmap from every task
    bits = known.select(*at(known.columns[0])).repartition("_map").groupBy("_map", "_bit").agg(F.count(F.lit(1)).alias("_n"))
    sets = {"_words": F.col("_bit")} | ({"_twice": F.when(F.col("_n") > 1, F.col("_bit"))} if own else {})
    maps = bits.groupBy("_map").agg(*[F.hex(F.bitmap_construct_agg(c)).alias(name) for name, c in sets.items()])

    def words(text: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.conv(F.substring(text, i * 16 + 1, F.lit(16)), 16, -10).cast("long"))

    found = rows.select("*", *at(key)).join(F.broadcast(maps.select("_map", *[words(name).alias(name) for name in sets])), "_map")
    # eight bytes make a word, the first one its highest; in a byte the first bit is the lowest
    bit = F.col("_bit")
    place = F.lit(56) - bit.bitwiseAND(F.lit(56)) + bit.bitwiseAND(F.lit(7))
    number = F.shiftright(bit, 6).cast("int")
    word = F.get("_words", number)
    if own:
        word = F.when(F.col(own), F.get("_twice", number)).otherwise(word)
    return found.where(F.getbit(word, place.cast("int")) == 1).drop("_map", "_bit", *sets)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside a higher-order function."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def edits_within_band(a: Column, b: Column, threshold: int) -> Column:
    """The edit distance of ``a`` and the no shorter ``b`` if at most ``threshold``, else more than that.

    Both need more than ``threshold`` characters, and lengths at most that far
    apart. The matrix has a row for each character of ``a`` and is walked column
    by column; of column j only the rows j + threshold - width + 1 ... j + threshold
    are kept, as two integers: bit t of ``up`` (``down``) is set where a cell is one
    more (less) than the cell above it. ``dist`` follows the band's lowest cell
    down the diagonal, and from where that leaves the matrix, along the last row.
    """
    width = 2 * threshold + 2
    ones, top = (1 << width) - 1, 1 << (width - 1)
    lit = F.lit

    def invert(x):
        return x.bitwiseXOR(lit(ones))

    def walk(chars_a, chars_b, size_a):
        def column(acc, j):
            c = F.get(chars_b, j - 1)
            bits = lit(0)
            for t in range(width):
                row = j + lit(threshold - width + 1 + t)
                bits = bits.bitwiseOR(F.when((row >= 1) & (F.get(chars_a, F.greatest(row, lit(1)) - 1) == c), lit(1 << t)).otherwise(lit(0)))

            def cells(same):
                up, down = acc["up"], acc["down"]
                diagonal = (same.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(same).bitwiseOR(down).bitwiseAND(lit(ones))

                def close(d):
                    right = down.bitwiseOR(invert(d.bitwiseOR(up)))
                    left = d.bitwiseAND(up)
                    past = j - (size_a - lit(threshold))
                    last = F.pow(lit(2.0), lit(width - 1) - past).cast("int")
                    dist = F.when(past <= 0, acc["dist"] + (d.bitwiseAND(lit(top)) == 0).cast("int")).otherwise(
                        acc["dist"] + (right.bitwiseAND(last) != 0).cast("int") - (left.bitwiseAND(last) != 0).cast("int")
                    )
                    moved = F.shiftright(d, 1)
                    return F.struct(
                        left.bitwiseOR(invert(moved.bitwiseOR(right))).bitwiseAND(lit(ones)).alias("up"),
                        moved.bitwiseAND(right).alias("down"),
                        dist.alias("dist"),
                    )

                return _let(diagonal, close)

            return _let(bits, cells)

        first = F.struct(lit(ones ^ ((1 << (width - 1 - threshold)) - 1)).alias("up"), lit(0).alias("down"), lit(threshold).alias("dist"))
        return F.aggregate(F.sequence(lit(1), F.size(chars_b)), first, column, lambda acc: acc["dist"])

    return _let(F.split(a, ""), lambda ca: _let(F.split(b, ""), lambda cb: _let(F.size(ca), lambda n: walk(ca, cb, n))))


def _met_keys(able: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, a, n_a, l_a) of the index, and the probes (p_key, b, n_b, l_b) that may meet another line there."""
    index = index_keys(able).toDF("key", "a", "n_a", "l_a")
    probes = only_known(probe_keys(able).toDF("p_key", "b", "n_b", "l_b", "own"), "p_key", index.select("key"), "own")
    return index, probes.drop("own")


def _comparable() -> Column:
    """Whether two lines that met may be near: in the order of a link, and not told apart by their letters."""
    shorter = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    # lines of many near copies share segments without being alike: the join itself leaves out what letters tell apart
    return shorter & (letters_apart(F.col("l_a"), F.col("l_b")) <= 2 * allowed_edits(F.col("n_a")))


def _near(met: DataFrame, able: DataFrame) -> DataFrame:
    """(a, b): the pairs of ``met`` (a, n_a, b) that are near."""
    pairs = stored(met.select("a", "b", allowed_edits(F.col("n_a")).alias("edits")).distinct(), "line-pairs")
    # only lines of some pair are shuffled to meet it
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    text = flag_members(able.select("id", "line"), F.col("id"), ends).where("_maybe").drop("_maybe")
    both = pairs.join(text.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
    both = both.join(text.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    both = both.where(edits_within_band(F.col("line_a"), F.col("line_b"), THRESHOLD) <= F.col("edits"))
    return stored(both.select("a", "b"), "line-links")


def line_links(lines: DataFrame) -> DataFrame:
    """(a, b): every pair of distinct lines that are near, ``a`` the shorter (or, at equal length, smaller id)."""
    able = lines.where(F.col("chars") >= PER_EDIT)
    index, probes = _met_keys(able)
    return _near(index.join(probes, (F.col("key") == F.col("p_key")) & _comparable()), able)


def line_comps(lines: DataFrame) -> DataFrame:
    """(id, comp): the class of every line that is near another one, as all of ``line_links`` connect them, from fewer pairs.

    Under each key, lines are first compared with one of those indexed there only.
    Lines that this connects need not be compared with each other again: the second
    pass takes every other pair of a key whose classes are still apart.
    """
    able = lines.where(F.col("chars") >= PER_EDIT)
    index, probes = _met_keys(able)
    index, probes = stored(index, "line-index"), stored(probes, "line-probes")
    first = index.groupBy("key").agg(F.min(F.struct("n_a", "a", "l_a")).alias("first"), F.count(F.lit(1)).alias("here"))
    met = first.select("key", "first.*", "here").join(probes, F.col("key") == F.col("p_key"))
    links = _near(met.where(_comparable()), able)
    comps = stored(components(links).toDF("id", "comp"), "line-comps")
    # keys with one indexed line are done
    crowded = stored(met.where("here > 1").select("key").distinct(), "line-keys")

    def in_class(rows: DataFrame, key: str, end: str) -> DataFrame:
        rows = only_known(rows, key, crowded)
        return rows.join(comps.toDF("_id", f"c_{end}"), F.col(end) == F.col("_id"), "left").drop("_id").withColumn(f"c_{end}", F.coalesce(f"c_{end}", end))

    apart = (F.col("key") == F.col("p_key")) & (F.col("c_a") != F.col("c_b")) & _comparable()
    more = _near(in_class(index, "key", "a").join(in_class(probes, "p_key", "b"), apart), able)
    # a star of each class so far, and what connects the classes
    return components(comps.select(F.col("id").alias("a"), F.col("comp").alias("b")).unionByName(more)).toDF("id", "comp")


def line_classes(docs: DataFrame) -> DataFrame:
    """Every distinct line: id, line_key, chars, doc_id (smallest), copies, n_links, comp (class, by line id).

    A class is what links connect; a line without links is its own class.
    """
    lines = distinct_lines(docs)
    links = line_links(lines)
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    comps = components(links).select(F.col("node").alias("id"), "comp")
    linked = degree.join(comps, "id")
    # only the line's key goes through the join, not its text
    lines = lines.select("id", text_key(F.col("line")).alias("line_key"), "chars", "doc_id", "copies")
    return lines.join(linked, "id", "left").withColumns({"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "comp": F.coalesce("comp", "id")})


def drop_repeated_lines(docs: DataFrame, size_column: str | None = None) -> DataFrame:
    """``docs`` with only the first line of each class (by doc_id, then place) left in its place.

    Blank lines stay. A document that loses lines and keeps no
    other text goes; one without any text stays as it was. Rows with the same
    doc_id and text are one document here: they keep the same lines. Columns are
    those of ``docs``; ``size_column`` names one that holds the text's characters.
    """
    docs = docs.withColumns({"_key": text_key(F.col("text")), "_id": F.col("doc_id")})
    lines = distinct_lines(docs)
    classes = lines.select("id", text_key(F.col("line")).alias("line_key"), "copies").join(line_comps(lines), "id", "left")
    shared = classes.where("copies > 1 OR comp IS NOT NULL").select("line_key", F.coalesce("comp", "id").alias("comp"))
    places = docs.select("_id", "_key", F.posexplode(F.split("text", "\n")).alias("at", "line")).where("trim(line) <> ''")
    places = places.select("_id", "_key", "at", text_key(F.col("line")).alias("line_key")).join(shared, "line_key").drop("line_key")
    places = stored(places, "line-places")
    first = places.groupBy("comp").agg(F.min(F.struct("_id", "_key", "at")).alias("first"))
    later = places.join(first, "comp").where(~F.col("first").eqNullSafe(F.struct("_id", "_key", "at")))
    gone = later.groupBy("_id", "_key").agg(F.collect_set("at").alias("gone"))
    gone = gone.select(F.col("_id").alias("g_id"), F.col("_key").alias("g_key"), "gone")
    rows = docs.join(gone, F.col("_id").eqNullSafe(F.col("g_id")) & (F.col("_key") == F.col("g_key")), "left")
    kept = F.filter(F.split("text", "\n"), lambda line, at: ~F.array_contains("gone", at))
    rows = rows.withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    if size_column:
        size = F.char_length("text").cast(docs.schema[size_column].dataType)
        rows = rows.withColumn(size_column, F.when(F.col("gone").isNull(), F.col(size_column)).otherwise(size))
    rows = rows.where("gone IS NULL OR trim(text) <> ''")
    return rows.select([c for c in docs.columns if c not in ("_key", "_id")])
