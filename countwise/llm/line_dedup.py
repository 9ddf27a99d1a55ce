"""Line dedup by a segment-partition edit join (operator 1), in DataFrame functions only.

A line goes if an earlier line of the collection, by (doc_id, text, line
number), is equal or within a few character edits.  Longer lines may differ by
more of them: the shorter line of a pair decides, by its length class.

1. Equal lines: the first place of every distinct line, by a 128-bit hash.
2. Near lines: a line of a class with e edits is cut into e + 1 segments.  Of
   two lines within e edits the longer one holds some segment of the shorter
   one unchanged, shifted by no more than the edits allow.  Segments are
   indexed under (length of the line, segment number, text); each line probes
   the index for its own length and up to e less, at the few starts that the
   segment's place and the difference in length permit.
3. Lines that meet must have nearly the same set of words, by a bitmap of 64
   bits of which an edit can change three; only then their texts are fetched
   and compared by an automaton that keeps, for each number of errors, one
   bit per diagonal of the band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import stored

#: (least characters, edits) of the length classes.  Shorter lines are not
#: compared with near ones: an edit would join unrelated ones.  A line of a
#: class with e edits has 4, 12, 26 .. probes for e = 1, 2, 3 ..; see the README
#: for what more edits cost.
EDIT_CLASSES = ((20, 1),)
#: Equal lines of so many characters are removed, if they are not blank.
EXACT_CHARS = 1


def segments(n: Column, count: int) -> list[tuple[Column, Column]]:
    """(first character, length) of the segments of a line of n characters: even ones, the longer ones last."""
    size, longer = F.floor(n / count), n % count
    out, start = [], F.lit(1)
    for i in range(count):
        length = size + F.when(F.lit(count - i) <= longer, 1).otherwise(0)
        out.append((start, length))
        start = start + length
    return out


def _key(n: Column, i: int, text: Column) -> Column:
    return F.xxhash64(n.cast("int"), F.lit(i), text)


def index_keys(line: Column, n: Column, edits: int) -> Column:
    """Keys of the segments of a line of n characters."""
    return F.array(*[_key(n, i, F.substring(line, s.cast("int"), k.cast("int"))) for i, (s, k) in enumerate(segments(n, edits + 1))])


def probe_keys(line: Column, n: Column, edits: int, d: int) -> Column:
    """Keys under which a line of n characters meets those with d characters less.

    A segment after i others can start from max(-i, d - (edits - i)) to
    min(i, d + (edits - i)) characters later: the errors before it and those
    behind it leave no more.
    """
    keys = []
    short = n - d
    for i, (s, k) in enumerate(segments(short, edits + 1)):
        for shift in range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1):
            start = s + shift
            fits = (start >= 1) & (start + k - 1 <= n) & (k > 0)
            keys.append(F.when(fits, _key(short, i, F.substring(line, start.cast("int"), k.cast("int")))))
    return F.filter(F.array(*keys), lambda x: x.isNotNull())


def _by_class(n: Column, classes: tuple[tuple[int, int], ...], value) -> Column:
    """``value(edits)`` of the class of a line of n characters, null below all classes."""
    out = F.lit(None)
    for least, edits in sorted(classes):
        out = F.when(n >= least, value(edits)).otherwise(out)
    return out


def all_probes(line: Column, n: Column, classes: tuple[tuple[int, int], ...]) -> Column:
    """(key, shorter) of all lines that a line of n characters may be near to."""
    none = F.array().cast("array<bigint>")
    parts = []
    for d in range(max(e for _, e in classes) + 1):
        keys = F.coalesce(_by_class(n - d, classes, lambda e: probe_keys(line, n, e, d) if d <= e else none), none)
        parts.append(F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(d > 0).alias("shorter"))))
    return F.concat(*parts)


def word_bits(line: Column) -> Column:
    """A bit per word of the line, by hash, flipped for each time it occurs."""
    return F.aggregate(F.split(line, " "), F.lit(0).cast("bigint"), lambda bits, word: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(word), F.lit(64)).cast("int"))))


def within_edits(a: Column, b: Column, edits: int, allowed: Column | None = None) -> Column:
    """Are the strings ``a`` and ``b`` within ``edits`` edits, or ``allowed`` ones if that is less?

    Row e of the automaton holds the diagonals (of 2 edits + 1 around the main
    one) that the text so far reaches with at most e errors, as bits of one
    integer.  A character moves all diagonals at once: equal ones stay, a
    substitution stays with one more error, an extra character in ``b`` moves
    down a diagonal, and one in ``a`` moves up within the same step.
    """
    # A lambda's argument is computed once; a column could be computed again at every step.
    both = F.array(F.struct(_characters(a).alias("a"), _characters(b).alias("b"), (F.lit(edits) if allowed is None else allowed).alias("most")))
    return F.get(F.transform(both, lambda x: _automaton(x["a"], x["b"], edits, x["most"])), 0)


def _automaton(a: Column, b: Column, edits: int, most: Column) -> Column:
    width = 2 * edits + 1
    full = (1 << width) - 1

    def closed(rows: list[Column]) -> list[Column]:
        out = [rows[0]]
        for e in range(1, edits + 1):
            out.append(rows[e].bitwiseOR(F.shiftleft(out[e - 1], 1)).bitwiseAND(F.lit(full)))
        return out

    def step(state: Column, j: Column) -> Column:
        same = F.lit(0)
        for d in range(-edits, edits + 1):
            at = j + d
            same = same + F.when((at >= 0) & (at < F.size(a)) & (F.get(a, at) == F.get(b, j)), 1 << (d + edits)).otherwise(0)
        rows = []
        for e in range(edits + 1):
            row = state[e].bitwiseAND(same)
            if e:
                row = row.bitwiseOR(state[e - 1]).bitwiseOR(F.shiftright(state[e - 1], 1))
            rows.append(row)
        return F.when(state[edits] == 0, state).otherwise(F.array(*closed(rows)))

    first = closed([F.lit(1 << edits)] + [F.lit(1 << edits)] * edits)
    last = F.aggregate(F.when(F.size(b) > 0, F.sequence(F.lit(0), F.size(b) - 1)).otherwise(F.array().cast("array<int>")), F.array(*first), step)
    end = F.size(a) - F.size(b) + edits
    return F.when(F.abs(F.size(a) - F.size(b)) > most, False).otherwise(
        F.call_function("shiftright", F.get(last, most), end).bitwiseAND(F.lit(1)) == 1)


def _whole(row: str) -> Column:
    """The struct column ``row`` with all its fields: whatever is used of it
    later, every join shuffles the same columns, and so the documents once."""
    return F.get(F.transform(F.array(row), lambda r: r), 0)


def _characters(line: Column) -> Column:
    return F.filter(F.split(line, ""), lambda c: c != "")


def _text_key(text: Column) -> Column:
    """60 bits of a text's MD5: rows that repeat a doc_id with other texts are other places."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(-1).cast("bigint"))


def dedup_lines(docs: DataFrame, classes: tuple[tuple[int, int], ...] = EDIT_CLASSES, exact_chars: int = EXACT_CHARS) -> DataFrame:
    """The rows and columns of ``docs`` (doc_id, text, ..) with n_lines, n_removed and kept_text.

    Lines end at line feeds.  A line goes if an earlier line is equal, from
    ``exact_chars`` characters on and unless it is blank, or near, by
    ``classes`` of (least characters, edits).  The others stay and remove
    nothing.  Kept lines are joined by line feeds.  A null text has no line and
    stays null; an empty text has one, empty line.  A null doc_id counts as one
    id, before all others.  Rows that repeat a doc_id come in the order of their
    texts' MD5; rows equal in doc_id and text are one place, so they do not
    remove each other's lines.  Other columns pass through; one named like a
    result is replaced.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_removed", "kept_text")]
    rows = docs.select(F.struct("doc_id", _text_key(F.col("text")).alias("text_key")).alias("doc"),
                       F.struct("text", *[F.col(f"`{c}`") for c in others]).alias("row"))
    each = rows.select("doc", F.posexplode_outer(F.split("row.text", "\n")).alias("line_no", "line"))
    min_chars, max_edits = min(least for least, _ in classes), max(edits for _, edits in classes)

    def compared(line: Column) -> Column:
        n = F.char_length(line)
        return (n >= min_chars) | ((n >= exact_chars) & line.rlike(r"[^\x20\x09-\x0D]"))

    each = each.withColumn("n", F.char_length("line")).filter(compared(F.col("line")))
    line, n = F.col("line"), F.col("n")
    long = n >= min_chars
    heads = stored(
        each.groupBy(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2")).agg(
            F.min(F.struct("doc", "line_no")).alias("place"),
            F.first(F.struct(_by_class(n, classes, F.lit).alias("edits"), F.when(long, word_bits(line)).alias("bits"),
                             _by_class(n, classes, lambda e: index_keys(line, n, e)).alias("index"),
                             F.when(long, all_probes(line, n, classes)).alias("probes"))).alias("own")).select("place", "own.*"), "line-heads")

    a, b = (F.struct(F.struct(F.col("doc_" + x).alias("doc_id"), F.col("text_key_" + x).alias("text_key")).alias("doc"), F.col("line_no_" + x).alias("line_no"))
            for x in "ab")
    indexed, probing = (heads.select(
        F.col("place.doc.doc_id").alias("doc_" + x), F.col("place.doc.text_key").alias("text_key_" + x), F.col("place.line_no").alias("line_no_" + x),
        F.col("bits").alias("bits_" + x), F.col("edits").alias("edits_" + x), F.explode(keys).alias(k)) for x, keys, k in (("a", "index", "key"), ("b", "probes", "probe")))
    probing = probing.select("doc_b", "text_key_b", "line_no_b", "bits_b", "probe.*")
    met = indexed.join(probing, (indexed["key"] == probing["key"]) & (F.col("shorter") | (a < b)) & (
        F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= 3 * F.col("edits_a"))).select(a.alias("a"), b.alias("b"), F.col("edits_a").alias("edits")).distinct()

    def with_line(pairs: DataFrame, place: str) -> DataFrame:
        return pairs.join(rows, F.col(place + ".doc") == F.col("doc")).drop("doc").withColumn(
            "line_" + place, F.get(F.split(_whole("row")["text"], "\n"), F.col(place + ".line_no"))).drop("row")

    close = with_line(with_line(met, "a"), "b").filter(within_edits(F.col("line_a"), F.col("line_b"), max_edits, F.col("edits")))
    later = close.select(F.greatest("a", "b").alias("later")).groupBy(F.col("later.doc").alias("near_doc")).agg(
        F.collect_set("later.line_no").alias("near"))
    first = heads.groupBy(F.col("place.doc").alias("first_doc")).agg(F.collect_set("place.line_no").alias("first"))

    none = F.array().cast("array<int>")
    decided = (rows.join(first, F.col("doc") == F.col("first_doc"), "left").join(later, F.col("doc") == F.col("near_doc"), "left")
               .select("doc", _whole("row").alias("row"), F.array_except(F.coalesce("first", none), F.coalesce("near", none)).alias("kept"))
               .select("doc", "row", "kept", F.split("row.text", "\n").alias("lines")))
    short = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~compared(F.get("lines", i)))
    at = decided.withColumn("at", F.sort_array(F.filter(F.concat("kept", short), lambda i: i < F.size("lines"))))
    done = at.select(
        "doc", "row", F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("at"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.array_join(F.transform("at", lambda i: F.get("lines", i)), "\n").alias("kept_text"))
    return done.select(*[F.col("doc" if c == "doc_id" else "row").getField(c).alias(c) for c in docs.columns if c in ("doc_id", "text", *others)],
                       "n_lines", "n_removed", "kept_text")
