"""Invertible Bloom lookup sketches of texts' paragraphs, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.ranking import global_position

from .common import saved

#: A paragraph ends at a line break or the end of a sentence, and after so many code points.
LONGEST = 100
PARAGRAPH = rf"[^.!?\n]{{1,{LONGEST}}}[.!?]*|[.!?]+"
#: Cells of each of the three tables of a text's sketch, and where the bits of a digest's cells begin.
CELLS, SHIFTS = 16, (0, 20, 40)
#: Divided sketches: digests are dealt by their top bits, one a step, to groups of at most about
#: ``GROUP``, with a sketch each.
GROUP, STEPS = 8, 30
CELLS_OF_GROUP, SHIFTS_OF_GROUP = 8, (0, 10, 20)
#: The larger sketch of a group whose first one doesn't peel: other bits, more cells.
CELLS_AGAIN, SHIFTS_AGAIN = 32, (3, 13, 24)
ROUNDS = 12


def _let(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it by name; ``transform`` would copy the result, cell by cell."""
    return f"aggregate(cast(array() as array<int>), {value}, (kept, _) -> kept, {name} -> {body})"


def digests(text: Column) -> Column:
    """The distinct 64-bit hashes of a text's paragraphs, as an array; leading spaces don't count."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.ltrim(p))
    return F.array_distinct(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.xxhash64(p)))


NONE = "named_struct('n', 0, 'k', 0L, 'c', 0L)"
TABLES = ("t0", "t1", "t2")


def _tables(make) -> str:
    """SQL of a struct with an array of cells for each table."""
    return "named_struct(" + ", ".join(f"'{t}', {make(t, j)}" for j, t in enumerate(TABLES)) + ")"


def _dealt(items: str, bits: str) -> str:
    """SQL of the arrays into which digests are dealt, by each bit of the array ``bits``, longs with one bit set, in turn."""
    halves = "array(filter(p, x -> (x & b) = 0L), filter(p, x -> (x & b) <> 0L))"
    return f"aggregate({bits}, array({items}), (held, b) -> flatten(transform(held, p -> {halves})))"


def _own(key: str, cells: int, shift: int) -> str:
    """SQL of the bits of a digest that choose its cell, left in their place: the cell's ``i`` in a list of filled cells."""
    return f"({key} & {(cells - 1) << shift}L)"


FILLED = "c -> c.n <> 0 or c.k <> 0 or c.c <> 0"
ADD = "(a, x) -> named_struct('n', a.n + 1, 'k', a.k ^ x, 'c', a.c ^ xxhash64(x))"


def _text_sketch(items: str) -> str:
    """SQL of the sketch of a text's digests: for each cell the count, the keys' and the checks' XOR."""
    bits = range(CELLS.bit_length() - 2, -1, -1)
    cells = [_dealt(items, "array(" + ", ".join(f"{1 << shift + bit}L" for bit in bits) + ")") for shift in SHIFTS]
    return _tables(lambda _, j: f"transform({cells[j]}, q -> aggregate(q, {NONE}, {ADD}))")


def _sketch_less(left: str, right: str, cells: int, shifts: tuple[int, ...]) -> str:
    """SQL of the sketch of a few digests less that of others: each cell takes in the first and gives off the second.

    Only the filled cells are listed; ``flatten`` joins arrays with less work than ``concat``.
    """
    signed = "transform({}, x -> named_struct('n', {}, 'k', x, 'c', xxhash64(x)))"
    add = "(a, x) -> named_struct('i', a.i, 'n', a.n + x.n, 'k', a.k ^ x.k, 'c', a.c ^ x.c)"

    def table(_: str, j: int) -> str:
        own = _own("x.k", cells, shifts[j])
        cell = f"aggregate(filter(z, x -> {own} = i), named_struct('i', i, 'n', 0, 'k', 0L, 'c', 0L), {add})"
        return f"filter(transform(array_distinct(transform(z, x -> {own})), i -> {cell}), {FILLED})"

    return _let(f"flatten(array({signed.format(left, 1)}, {signed.format(right, -1)}))", "z", _tables(table))


def _minus(left: str, right: str) -> str:
    """SQL of one text's sketch less another's, cell by cell; only the filled cells are listed."""
    less = "(a, b) -> named_struct('n', a.n - b.n, 'k', a.k ^ b.k, 'c', a.c ^ b.c)"
    placed = "(c, i) -> named_struct('i', shiftleft(cast(i as bigint), {}), 'n', c.n, 'k', c.k, 'c', c.c)"
    return _tables(lambda t, j: f"filter(transform(zip_with({left}.{t}, {right}.{t}, {less}), {placed.format(SHIFTS[j])}), {FILLED})")


def _peeled(cells: str, size: int, shifts: tuple[int, ...]) -> str:
    """SQL of the differing digests (k, n: +1 left, -1 right) of a subtracted sketch; null if it doesn't peel.

    Every round takes the cells with one digest, whose check fits its key, each digest from the
    first table that has it so, and takes those digests out of all their cells. A cell left empty
    leaves the list; a round without any digest is the last.
    """
    one = "abs(c.n) = 1 and xxhash64(c.k) = c.c"

    def pure(body: str) -> str:
        first, second, third = (f"filter(s.{t}, c -> {one}{{}})" for t in TABLES)
        new = " and not exists({}, q -> q.k = c.k)"
        every = f"flatten(array(f, g, {third.format(new.format('f') + new.format('g'))}))"
        return _let(first.format(""), "f", _let(second.format(new.format("f")), "g", _let(every, "p", body)))

    def taken(t: str, j: int) -> str:
        less = "(a, q) -> named_struct('i', a.i, 'n', a.n - q.n, 'k', a.k ^ q.k, 'c', a.c ^ q.c)"
        own = _own("q.k", size, shifts[j])
        cell = f"if(array_contains(h, c.i), aggregate(filter(p, q -> {own} = c.i), c, {less}), c)"
        return _let(f"transform(p, q -> {own})", "h", f"filter(transform(s.{t}, c -> {cell}), {FILLED})")

    def state(make, found: str, done: str) -> str:
        return "named_struct(" + ", ".join(f"'{t}', {make(t, j)}" for j, t in enumerate(TABLES)) + f", 'found', {found}, 'done', {done})"

    step = pure(f"if(size(p) = 0, {state(lambda t, _: f's.{t}', 's.found', 'true')}, {state(taken, 'flatten(array(s.found, p))', 'false')})")
    start = _let(cells, "z", state(lambda t, _: f"z.{t}", "cast(array() as array<struct<i: bigint, n: int, k: bigint, c: bigint>>)", "false"))
    left = " or ".join(f"size(s.{t}) > 0" for t in TABLES)
    found = "transform(s.found, q -> named_struct('k', q.k, 'n', q.n))"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> if(s.done, s, {step}), s -> if({left}, null, {found}))"


def _exact(left: str, right: str) -> str:
    """SQL of the differing digests taken from the digests themselves."""
    one = "transform(array_except({}, {}), k -> named_struct('k', k, 'n', {}))"
    return f"concat({one.format(left, right, 1)}, {one.format(right, left, -1)})"


def _difference(left: str, right: str, left_cells: str, right_cells: str) -> str:
    """SQL of the differing digests of two texts.

    The sketches are subtracted and peeled. On failure the digests are dealt to groups of
    which each has a sketch of its own, so that there is room for all, with three cells or
    more a digest. A group that fails gets a larger sketch, and one that fails even then is
    compared digest by digest. The work grows with the digests times their logarithm.
    """
    first = _peeled(_minus(left_cells, right_cells), CELLS, SHIFTS)

    def tried(cells: int, shifts: tuple[int, ...]) -> str:
        return _peeled(_sketch_less("l", "r", cells, shifts), cells, shifts)

    nothing = "cast(array() as array<struct<k: bigint, n: int>>)"
    found = f"coalesce({tried(CELLS_OF_GROUP, SHIFTS_OF_GROUP)}, {tried(CELLS_AGAIN, SHIFTS_AGAIN)}, {_exact('l', 'r')})"
    groups = f"zip_with({_dealt(left, 'd')}, {_dealt(right, 'd')}, (l, r) -> if(size(l) + size(r) = 0, {nothing}, {found}))"
    steps = f"cast(least({STEPS}, greatest(0, ceil(log2(greatest(1, (size({left}) + size({right})) / {GROUP}))))) as int)"
    bits = f"transform(slice(sequence(63, {64 - STEPS}), 1, {steps}), b -> shiftleft(1L, b))"
    return f"coalesce({first}, {_let(bits, 'd', f'flatten({groups})')})"


def _likeness(found: Column, left: Column, right: Column) -> Column:
    """Shared digests over all, from the differing ones: 1 for two texts without paragraphs."""
    d, both = F.size(found), F.size(left) + F.size(right)
    return F.when(both == 0, 1.0).otherwise((both - d) / (both + d)).cast("double")


def compared(rows: DataFrame, left: str, right: str, out: str, left_cells: str, right_cells: str) -> DataFrame:
    """Add ``out``: the digests, as (k, n), in which two digest columns with their sketch columns differ."""
    return rows.withColumn(out, F.expr(_difference(left, right, left_cells, right_cells)))


def sketched(rows: DataFrame, items: str, out: str) -> DataFrame:
    """Add ``out``: the sketch of a column of digests."""
    return rows.withColumn(out, F.expr(_text_sketch(items)))


def sketch_text(cells: str) -> Column:
    """A sketch as text: count, key and check of each cell; the same for equal texts."""
    every = ", ".join(f"{cells}.{t}" for t in TABLES)
    return F.expr(f"array_join(transform(concat({every}), c -> concat(c.n, '.', lower(hex(c.k)), '.', lower(hex(c.c & 4294967295L)))), ' ')")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edited_part: int = 4) -> DataFrame:
    """Fingerprints of texts and of their edited versions, and how like they are.

    The edited text replaces the last quarter (``edited_part``) of the code points by the
    first as many, or all, of the next document by ascending id; the first follows the last.
    Returns (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, lost, won): likeness to the edited text and to the next document, and the
    digests of the paragraphs that the edit took away and brought, as recovered from the
    sketches.

    A null text counts as empty; the null id comes first. Rows of one id each get a row, all
    with the same next document; of several texts of an id the smallest is the next
    document's. Other columns are left out, an empty table gives no rows.

    Ids are ordered without their texts, by a range sort. A text moves once, to its id;
    from there its beginning and its digests go to the id before. Ids may be of any type
    that can be ordered; a struct of the id alone is the key, so that null meets null.
    """
    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.groupBy("key").agg(F.max(F.length("text")).alias("n"))
    ids = saved(global_position(saved(ids, "id-sizes"), ["key"], "at"), "id-order")
    total = max(1, ids.count())
    needs = ids.select(F.col("key").alias("to"), F.floor(F.col("n") / edited_part).cast("int").alias("most"), ((F.col("at") + 1) % total).alias("at"))
    needs = needs.join(ids.select("key", "at"), "at").select("key", "to", "most")

    # both sides of the last join read the one exchange of the texts by id
    before = F.lag("key").over(Window.partitionBy("key").orderBy("text"))
    first = rows.withColumn("before", before).where("before is null").select("key", "text")
    sent = first.join(needs, "key").select(F.col("to").alias("key"), F.expr("substring(text, 1, most)").alias("begin"), digests(F.col("text")).alias("next_items"))

    both = rows.join(sent, "key").withColumn("n", F.length("text"))
    both = both.withColumn("cut", F.floor(F.col("n") / edited_part).cast("int"))
    both = both.withColumn("edited", F.expr("concat(substring(text, 1, n - cut), substring(begin, 1, cut))"))
    both = both.select(
        F.col("key.id").alias("id"),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("items"),
        digests(F.col("edited")).alias("edited_items"),
        "next_items",
    )
    for items in ("items", "edited_items", "next_items"):
        both = sketched(both, items, f"{items}_cells")
    both = compared(both, "items", "edited_items", "by_edit", "items_cells", "edited_items_cells")
    both = compared(both, "items", "next_items", "to_next", "items_cells", "next_items_cells")
    return both.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        sketch_text("items_cells").alias("fingerprint"),
        sketch_text("edited_items_cells").alias("edited_fingerprint"),
        _likeness(F.col("by_edit"), F.col("items"), F.col("edited_items")).alias("near_edited"),
        _likeness(F.col("to_next"), F.col("items"), F.col("next_items")).alias("near_next"),
        F.expr("transform(filter(by_edit, d -> d.n > 0), d -> d.k)").alias("lost"),
        F.expr("transform(filter(by_edit, d -> d.n < 0), d -> d.k)").alias("won"),
    )
