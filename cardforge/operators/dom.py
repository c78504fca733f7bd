"""Page structure and the rule extractors over it (DOM-1 .. DOM-9).

A page is one row, and its structure is found inside that row: one pass over
its tokens with a stack of open elements (an Arrow-batched function), exact for
any nesting.  There are two forms of it:

* ``dom_nodes``: one output row a token (start tag, end tag, text);
* ``page_trees``: one output row a page, the elements as an array with their
  place in the page's text and markup.

Every operator after that is a projection over ``page_trees``: no shuffle, no
window, no join.  The text of an element is a substring of the page's text, its
markup a substring of the page's html.

Pairing follows a lenient HTML tree builder: an end tag closes the most recent
open element of its name and all that was opened inside it; an end tag without
an open element of its name is ignored; void and self-closed elements hold
nothing; what is open at the end ends with the page.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardforge.functions._col import let
from cardforge.functions.text import nbsp_to_space, strip_ws
from cardforge.functions.urls import resolve_url
from cardforge.operators.tokens import START, TEXT, PageTokens, read_attributes, read_tokens

#: tokens of several pages that leave a task together
EMIT_TOKENS = 20_000
#: pages that come to a task at once
BATCH_PAGES = 1_500
#: characters of html that a task reads into elements at once
PORTION_CHARS = 1_000_000
#: start tags whose attributes are kept while a portion is read, and their greatest length
KNOWN_TAGS, SHORT_TAG = 2_000, 200

PAIRS = T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())]))
ELEMENT = T.StructType([T.StructField(n, t) for n, t in (
    ("pos", T.IntegerType()), ("end_pos", T.IntegerType()), ("name", T.StringType()), ("attrs", PAIRS),
    ("depth", T.IntegerType()), ("parent", T.IntegerType()),
    # text [t0, t1) in the page's text; markup [m0, m1) in its html; contents up to m_end
    ("t0", T.IntegerType()), ("t1", T.IntegerType()), ("m0", T.IntegerType()), ("m_end", T.IntegerType()),
    ("m1", T.IntegerType()))])


def _ints(column) -> np.ndarray:
    return np.frombuffer(column, dtype=np.int32) if len(column) else np.zeros(0, dtype=np.int32)


def _attributes(raws) -> pa.Array:
    """``array<struct<k, v>>`` of start tags (None: null)."""
    keys, values, ends, null, known = [], [], [0], [], {}
    for raw in raws:
        found = ()
        if raw is not None:
            found = known.get(raw)
            if found is None:
                found = read_attributes(raw)
                if len(raw) <= SHORT_TAG and len(known) < KNOWN_TAGS:
                    known[raw] = found
        for k, v in found:
            keys.append(k)
            values.append(v)
        ends.append(len(keys))
        null.append(raw is None)
    pairs = pa.StructArray.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string())], ["k", "v"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs, mask=pa.array(null, pa.bool_()) if null else None)


def _small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of pages small (a session option, lowered only)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_PAGES:
        spark.conf.set(key, str(BATCH_PAGES))


def _portions(column: pa.Array):
    """``(row, html)`` lists of a batch's pages, each up to PORTION_CHARS of html or one page: what
    a task holds does not grow with the rows of a batch."""
    held, size = [], 0
    for row in range(len(column)):
        html = column[row].as_py() or ""
        if held and size + len(html) > PORTION_CHARS:
            yield held
            held, size = [], 0
        held.append((row, html))
        size += len(html)
    if held:
        yield held


def dom_nodes(pages: DataFrame) -> DataFrame:
    """DOM-1: ``pages(page_id, url, html)`` -> one row a token: page_id, url, pos,
    kind ('start'|'end'|'text'), name, attrs (array<struct<k,v>>), text (decoded,
    text tokens only), raw, end_pos (where the element's own end tag is, or the
    token that closed it, or past the last token; = pos for void elements and
    other tokens), depth (number of open elements), parent_pos.

    One pass a page, no shuffle.  A null html has no tokens."""
    _small_batches(pages.sparkSession)
    key = pages.schema["page_id"].dataType
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("page_id", key), ("url", T.StringType()), ("pos", T.IntegerType()), ("kind", T.StringType()), ("name", T.StringType()),
        ("attrs", PAIRS), ("text", T.StringType()), ("raw", T.StringType()), ("end_pos", T.IntegerType()),
        ("depth", T.IntegerType()), ("parent_pos", T.IntegerType()))])
    kinds = pa.array(["start", "end", "text"])

    def emit(batch, parts: list[tuple[int, PageTokens, int, int, int]]) -> pa.RecordBatch:
        """Tokens ``[lo, hi)`` of each page, of which ``texts`` texts came before."""
        rows, pos, names, tags, texts, raws = [], [], [], [], [], []
        kind, ints = bytearray(), {c: array("i") for c in ("end_pos", "depth", "parent")}
        for row, page, lo, hi, text in parts:
            rows += [row] * (hi - lo)
            pos += range(lo, hi)
            names += page.name[lo:hi]
            kind += page.kind[lo:hi]
            for c, column in ints.items():
                column.extend(getattr(page, c)[lo:hi])
            for k in range(lo, hi):
                if page.kind[k] == TEXT:
                    tags.append(None)
                    texts.append(page.texts[text])
                    raws.append(page.raws[text])
                    text += 1
                else:
                    raw = page.raw(k)
                    tags.append(raw if page.kind[k] == START else None)
                    texts.append(None)
                    raws.append(raw)
        parent, row = _ints(ints["parent"]), pa.array(rows, pa.int32())
        cols = [batch.column(0).take(row), batch.column(1).take(row), pa.array(pos, pa.int32()),
                kinds.take(pa.array(np.frombuffer(kind, dtype=np.uint8))), pa.array(names, pa.string()),
                _attributes(tags), pa.array(texts, pa.string()), pa.array(raws, pa.string()),
                pa.array(_ints(ints["end_pos"])), pa.array(_ints(ints["depth"])), pa.array(parent, mask=parent < 0)]
        return pa.RecordBatch.from_arrays(cols, schema.names)

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for portion in _portions(batch.column(2)):
                for row, html in portion:
                    page, texts = read_tokens(html), 0
                    for lo in range(0, len(page), EMIT_TOKENS):
                        hi = min(lo + EMIT_TOKENS, len(page))
                        held.append((row, page, lo, hi, texts))
                        texts += page.kind[lo:hi].count(TEXT)
                        size += hi - lo
                        if size >= EMIT_TOKENS:
                            yield emit(batch, held)
                            held, size = [], 0
            if held:
                yield emit(batch, held)

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, schema)


def page_trees(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, text, els)``, one row a page: the whole text, and
    the elements in document order (see ``ELEMENT``).  A null html is ''."""
    _small_batches(pages.sparkSession)
    key = pages.schema["page_id"].dataType
    schema = T.StructType([T.StructField("page_id", key), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("els", T.ArrayType(ELEMENT))])
    own, of_token = ("pos", "t0", "t1", "m_end", "m1"), ("end_pos", "depth", "parent", "m0")

    def run(batches):
        for batch in batches:
            for portion in _portions(batch.column(2)):
                texts, ends, names, tags = [], [0], [], []
                ints = {c: array("i") for c in (*own, *of_token)}
                for _, html in portion:
                    page = read_tokens(html)
                    texts.append("".join(page.texts))
                    ends.append(ends[-1] + len(page.pos))
                    names += [page.name[k] for k in page.pos]
                    tags += [page.raw(k) for k in page.pos]
                    for c in own:  # a value an element; the others: a value a token
                        ints[c].extend(getattr(page, c))
                    for c in of_token:
                        column = getattr(page, c)
                        ints[c].extend([column[k] for k in page.pos])
                flat = {c: _ints(column) for c, column in ints.items()}
                fields = [pa.array(flat["pos"]), pa.array(flat["end_pos"]), pa.array(names, pa.string()), _attributes(tags),
                          pa.array(flat["depth"]), pa.array(flat["parent"], mask=flat["parent"] < 0),
                          *(pa.array(flat[c]) for c in ("t0", "t1", "m0", "m_end", "m1"))]
                els = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ELEMENT.names))
                part = batch.slice(portion[0][0], len(portion))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(texts, pa.string()), els],
                                                 schema.names)

    return pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).mapInArrow(run, schema)


# ---------------------------------------------------------------- elements

Predicate = Callable[[Column], Column]


def attr(attrs, name: str) -> Column:
    """Value of an attribute (last one wins), or null."""
    a = F.col(attrs) if isinstance(attrs, str) else attrs
    return F.try_element_at(F.filter(a, lambda p: p["k"] == name), F.lit(-1))["v"]


def has_class(attrs, cls: str) -> Column:
    """CSS class membership (class is a whitespace-separated list)."""
    return F.coalesce(F.array_contains(F.split(strip_ws(attr(attrs, "class")), r"\s+"), F.lit(cls)), F.lit(False))


def element(name: str | None = None, attr_name: str | None = None, value: str | None = None,
            css_class: str | None = None) -> Predicate:
    """Predicate of elements by tag, by an attribute's value, by class."""
    def pred(e: Column) -> Column:
        c = F.lit(True) if name is None else e["name"] == name
        if attr_name:
            c = c & F.coalesce(attr(e["attrs"], attr_name) == value, F.lit(False))
        return c & has_class(e["attrs"], css_class) if css_class else c
    return pred


MAIN = element("div", "id", "mainContent")


def first(pred: Predicate) -> Column:
    """The first element of the page (struct) for which ``pred`` holds, or null."""
    return F.get(F.filter("els", pred), 0)


def inside(e: Column, box: Column) -> Column:
    return (e["pos"] > box["pos"]) & (e["pos"] < box["end_pos"])


def text_of(e: Column) -> Column:
    return F.substr(F.col("text"), e["t0"] + 1, e["t1"] - e["t0"])


def markup_of(e: Column) -> Column:
    return F.substr(F.col("html"), e["m0"] + 1, e["m1"] - e["m0"])


# ---------------------------------------------------------------- DOM-2


def select_container(trees: DataFrame, pred: Predicate = MAIN, on_missing: str = "drop") -> DataFrame:
    """DOM-2: ``trees`` with ``box``, the first element of each page for which
    ``pred`` holds.  Pages without one are dropped (rule extractor) or, with
    ``on_missing='empty'``, kept with a null box (model requests)."""
    if on_missing not in ("drop", "empty"):
        raise ValueError("on_missing: 'drop' or 'empty'")
    t = trees.withColumn("box", first(pred))
    return t.where("box is not null") if on_missing == "drop" else t


def container_markup(trees: DataFrame, pred: Predicate = MAIN, on_missing: str = "drop") -> DataFrame:
    """``(page_id, url, container_html)``: the container's markup as it stands in
    the page (comments and scripts included), '' where it is missing and kept."""
    t = select_container(trees, pred, on_missing)
    return t.select("page_id", "url", F.coalesce(markup_of(F.col("box")), F.lit("")).alias("container_html"))


# ---------------------------------------------------------------- DOM-3


def heading_parts() -> tuple[Column, Column]:
    """Columns word and definition of a row of ``page_trees`` (with ``h1`` and
    ``sib``, see :func:`split_heading`)."""
    h1 = F.when(F.col("h1").isNotNull(), text_of(F.col("h1")))
    sib = F.when(F.col("sib").isNotNull(), strip_ws(text_of(F.col("sib"))))

    def split(which: int) -> Column:
        def of(t):
            plain = nbsp_to_space(strip_ws(t))
            return (F.when(F.instr(plain, " – ") > 0, F.get(F.split(plain, " – ", 2), which))
                    .when(F.instr(plain, " - ") > 0, F.get(F.split(plain, " - ", 2), which))
                    .otherwise(sib if which else strip_ws(t)))
        return F.when(h1.isNotNull(), let(h1, of))
    return split(0), split(1)


def _with_heading(trees: DataFrame) -> DataFrame:
    h1 = first(element("h1"))
    t = trees.withColumn("h1", h1)
    h = F.col("h1")
    return t.withColumn("sib", F.when(h.isNotNull(), first(
        lambda e: (e["pos"] > h["pos"]) & e["parent"].eqNullSafe(h["parent"]))))


def split_heading(trees: DataFrame) -> DataFrame:
    """DOM-3: word and definition from the first h1 of each page.

    t = stripped h1 text with NBSP -> space.  If it contains ' – ' it is
    split once there, else if it contains ' - ' split once there.  Otherwise
    word = stripped h1 text (NBSP kept) and definition = the stripped text of
    the h1's next sibling element (null when there is none).  A dash without
    the spaced form is treated as no separator.  Pages without h1: nulls.
    Returns (page_id, word, definition) for every page.
    """
    word, definition = heading_parts()
    return _with_heading(trees).select("page_id", word.alias("word"), definition.alias("definition"))


# ---------------------------------------------------------------- DOM-4


def image_array() -> Column:
    """``array<struct<pos, image>>`` of the container ``box``: every img with a
    non-empty src, resolved against the page URL, in order."""
    box = F.col("box")
    imgs = F.filter("els", lambda e: (e["name"] == "img") & inside(e, box) & (F.coalesce(attr(e["attrs"], "src"), F.lit("")) != ""))
    return F.transform(imgs, lambda e: F.struct(e["pos"].alias("pos"), resolve_url(F.col("url"), attr(e["attrs"], "src")).alias("image")))


def page_images(trees: DataFrame, pred: Predicate = MAIN) -> DataFrame:
    """DOM-4: (page_id, pos, image), duplicates kept."""
    t = select_container(trees, pred)
    return t.select("page_id", F.explode(image_array()).alias("i")).select("page_id", "i.pos", "i.image")


# ---------------------------------------------------------------- DOM-5/6

_BLOCK = T.StructType([T.StructField(n, t) for n, t in (
    ("pos", T.IntegerType()), ("processed", T.BooleanType()),
    # null unless the block is a mnemonic; red spans [lo, hi) of the page's are in the block
    ("mnemonic", T.StringType()), ("lo", T.IntegerType()), ("hi", T.IntegerType()))])
_RED = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("black", T.BooleanType())])
_WANTED = ("img", "p", "figcaption", "span")
_HASHES = ((2147483647, 1000003), (2147483629, 998244353), (2147483587, 754974721))  # fixed values: primes and bases


class _Markups:
    """Which markups of a page were seen before, by prefix hashes: a comparison does not read them."""

    def __init__(self, html: str):
        self.html, self.sums, self.seen = html, None, {}

    def _hashes(self):
        if self.sums is None:
            codes = np.frombuffer(self.html.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
            self.sums = []
            for prime, base in _HASHES:
                powers, done = np.ones(len(codes) + 1, dtype=np.uint64), 1
                while done < len(powers):
                    more = min(done, len(powers) - done)
                    powers[done:done + more] = powers[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
                    done += more
                sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(codes * powers[:-1] % np.uint64(prime)))) % np.uint64(prime)
                self.sums.append((prime, base, sums))
        return self.sums

    def _key(self, lo: int, hi: int) -> tuple:
        # divided by the power of its place, a hash depends on the characters alone
        return tuple((int(sums[hi]) - int(sums[lo])) * pow(base, -lo, prime) % prime for prime, base, sums in self._hashes())

    def new(self, lo: int, hi: int) -> bool:
        """Whether ``[lo, hi)`` was not seen yet; it is now."""
        rough = (hi - lo, self.html[lo:min(hi, lo + 32)], self.html[max(lo, hi - 32):hi])
        before = self.seen.get(rough)
        if before is None:  # the only one like it so far: no hash is needed
            self.seen[rough] = [(lo, hi)]
            return True
        if isinstance(before, list):
            before = self.seen[rough] = {self._key(*before[0])}
        key = self._key(lo, hi)
        if key in before:
            return False
        before.add(key)
        return True


def walk_blocks(html: str, text: str, names: list[str], colours: list[str], ints: dict[str, list[int]], box: tuple[int, int],
                ) -> tuple[list[tuple], list[tuple]]:
    """The p and figcaption blocks of a container, and its red spans.

    An img starts a new segment.  In the segment before the first img every
    block is processed; in a later one the blocks up to and including its first
    mnemonic.  A processed block is a mnemonic when it holds a red span, its
    text has no NOTE, and no earlier mnemonic has the same markup.

    Elements come as columns in order of ``pos`` (``colours``: the style of spans).
    Blocks hold offsets: those of a block's red spans among all, found by search in
    sorted positions, as are black spans in red ones and NOTEs in blocks.  Text is
    cut for mnemonics and red spans only.
    """
    pos, end_pos, t0, t1 = ints["pos"], ints["end_pos"], ints["t0"], ints["t1"]
    lo, hi = bisect_right(pos, box[0]), bisect_left(pos, box[1])
    black = [pos[i] for i in range(lo, hi) if "#000000" in colours[i]]
    red = [i for i in range(lo, hi) if "#ff0000" in colours[i]]
    red_pos = [pos[i] for i in red]
    notes, at = [], text.find("NOTE")
    while at >= 0:
        notes.append(at)
        at = text.find("NOTE", at + 4)
    seen, blocks = _Markups(html), []
    images, settled = 0, False
    for i in range(lo, hi):
        if names[i] == "img":
            images, settled = images + 1, False
        elif names[i] != "span":
            first, last = bisect_right(red_pos, pos[i]), bisect_left(red_pos, end_pos[i])
            processed, mnemonic = not settled, None
            if processed and first < last:
                note = bisect_left(notes, t0[i])
                if not (note < len(notes) and notes[note] + 4 <= t1[i]) and seen.new(ints["m0"][i], ints["m_end"][i]):
                    mnemonic, settled = text[t0[i]:t1[i]], images > 0
            blocks.append((pos[i], processed, mnemonic, first, last))

    def holds_black(i: int) -> bool:
        k = bisect_right(black, pos[i])
        return k < len(black) and black[k] < end_pos[i]

    return blocks, [(pos[i], text[t0[i]:t1[i]], holds_black(i)) for i in red]


def _colours(attrs: pa.Array) -> list[str]:
    """The style of each element (the last one of it), without spaces and lower-cased."""
    styles = []
    for pairs in attrs.to_pylist():
        style = next((p["v"] for p in reversed(pairs or ()) if p["k"] == "style"), "")
        styles.append(style.replace(" ", "").lower())
    return styles


def with_blocks(boxed: DataFrame) -> DataFrame:
    """Adds ``blocks`` and ``reds`` to the output of :func:`select_container`."""
    _small_batches(boxed.sparkSession)
    schema = T.StructType([*boxed.schema.fields, T.StructField("blocks", T.ArrayType(_BLOCK)), T.StructField("reds", T.ArrayType(_RED))])
    block = pa.struct([("pos", pa.int32()), ("processed", pa.bool_()), ("mnemonic", pa.string()), ("lo", pa.int32()), ("hi", pa.int32())])
    red = pa.struct([("pos", pa.int32()), ("text", pa.string()), ("black", pa.bool_())])

    def of_page(html: str, text: str, els: pa.StructArray, box: dict | None) -> tuple[list, list]:
        if box is None:
            return [], []
        els = els.filter(pc.is_in(els.field(ELEMENT.names.index("name")), pa.array(_WANTED)))
        name = els.field(ELEMENT.names.index("name"))
        span = np.flatnonzero(np.asarray(pc.equal(name, "span").to_numpy(zero_copy_only=False)))
        colours = [""] * len(els)
        for i, style in zip(span.tolist(), _colours(els.field(ELEMENT.names.index("attrs")).take(pa.array(span)))):
            colours[i] = style
        ints = {c: els.field(ELEMENT.names.index(c)).to_pylist() for c in ("pos", "end_pos", "t0", "t1", "m0", "m_end")}
        return walk_blocks(html, text, name.to_pylist(), colours, ints, (box["pos"], box["end_pos"]))

    def lists(rows: list[list[tuple]], kind: pa.StructType) -> pa.Array:
        flat = [x for row in rows for x in row]
        columns = [pa.array([x[i] for x in flat], kind.field(i).type) for i in range(kind.num_fields)]
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(row) for row in rows]))), pa.int32()),
                                        pa.StructArray.from_arrays(columns, [kind.field(i).name for i in range(kind.num_fields)]))

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            for portion in _portions(batch.column(names.index("html"))):
                part = batch.slice(portion[0][0], len(portion))
                html, text, els, box = (part.column(names.index(c)) for c in ("html", "text", "els", "box"))
                ends = np.asarray(els.offsets) - els.offsets[0].as_py()
                flat, boxes = els.flatten(), pc.struct_field(box, "pos").to_pylist()
                box_ends = pc.struct_field(box, "end_pos").to_pylist()
                done = [of_page(html[i].as_py(), text[i].as_py(), flat.slice(ends[i], ends[i + 1] - ends[i]),
                                None if boxes[i] is None else {"pos": boxes[i], "end_pos": box_ends[i]}) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, lists([b for b, _ in done], block), lists([r for _, r in done], red)],
                                                 [*names, "blocks", "reds"])

    return boxed.mapInArrow(run, schema)


def _mnemonic_array() -> Column:
    return F.transform(F.filter("blocks", lambda b: b["mnemonic"].isNotNull()),
                       lambda b: F.struct(b["pos"].alias("pos"), strip_ws(b["mnemonic"]).alias("mnemonic")))


def _block_highlights(b: Column) -> Column:
    """``array<struct<block_pos, pos, highlight>>`` of one block."""
    marked = F.transform(F.filter(F.slice("reds", b["lo"] + 1, b["hi"] - b["lo"]), lambda s: ~s["black"]),
                         lambda s: F.struct(b["pos"].alias("block_pos"), s["pos"].alias("pos"), strip_ws(s["text"]).alias("highlight")))
    return F.filter(marked, lambda s: F.instr(s["highlight"], "NOTE") == 0)


def _highlight_array() -> Column:
    return F.flatten(F.transform(F.filter("blocks", lambda b: b["processed"]), _block_highlights))


def highlights(trees: DataFrame, pred: Predicate = MAIN) -> DataFrame:
    """DOM-5: (page_id, block_pos, pos, highlight) - for each processed block,
    each red span under it without a black span inside and without 'NOTE' in
    its stripped text; text stripped (empty strings kept)."""
    t = with_blocks(select_container(trees, pred))
    blocks = t.select("page_id", "reds", F.explode(F.filter("blocks", lambda b: b["processed"] & (b["lo"] < b["hi"]))).alias("b"))
    return blocks.select("page_id", F.explode(_block_highlights(F.col("b"))).alias("h")).select("page_id", "h.*")


def mnemonic_blocks(trees: DataFrame, pred: Predicate = MAIN) -> DataFrame:
    """DOM-6: (page_id, pos, mnemonic) - stripped block text."""
    t = with_blocks(select_container(trees, pred))
    return t.select("page_id", F.explode(_mnemonic_array()).alias("m")).select("page_id", "m.*")


# ---------------------------------------------------------------- DOM-7


def extract_lessons(pages: DataFrame, pred: Predicate = MAIN) -> DataFrame:
    """DOM-7: one record per page that has a container: page_id, url, word,
    definition, mnemonic[], highlighted_text[], images[] (empty lists, not null).
    A projection of each page's row: nothing is shuffled or kept."""
    t = with_blocks(select_container(_with_heading(page_trees(pages)), pred))
    word, definition = heading_parts()
    return t.select("page_id", "url", word.alias("word"), definition.alias("definition"),
                    _mnemonic_array()["mnemonic"].alias("mnemonic"), _highlight_array()["highlight"].alias("highlighted_text"),
                    image_array()["image"].alias("images"))


# ---------------------------------------------------------------- DOM-8/9


def next_links(trees: DataFrame, base: str | None = None, css_class: str = "page-next") -> DataFrame:
    """DOM-8: (page_id, url, next_url) for every page.  The first
    ``div.page-next``, its first ``a``; href resolved against the page URL
    (or a fixed ``base``).  No div, no a, or no href -> null."""
    t = trees.withColumn("box", first(element("div", css_class=css_class)))
    box = F.col("box")
    t = t.withColumn("href", F.when(box.isNotNull(), attr(first(lambda e: (e["name"] == "a") & inside(e, box))["attrs"], "href")))
    base_col = F.lit(base) if base else F.col("url")
    return t.select("page_id", "url", F.when(F.col("href").isNotNull(), resolve_url(base_col, F.col("href"))).alias("next_url"))


def index_links(trees: DataFrame, pred: Predicate = element(css_class="grid-menu"), base: str | None = None,
                link_tag: str = "a") -> DataFrame:
    """DOM-9: (page_id, pos, link) - every ``a[href]`` under an element for which
    ``pred`` holds (all of them, of any tag), each link once, in order, resolved
    against ``base`` (or the page URL)."""
    t = trees.withColumn("boxes", F.filter("els", pred))
    links = F.filter("els", lambda e: (e["name"] == link_tag) & attr(e["attrs"], "href").isNotNull()
                     & F.exists("boxes", lambda b: inside(e, b)))
    a = t.select("page_id", "url", F.explode(links).alias("e"))
    base_col = F.lit(base) if base else F.col("url")
    return a.select("page_id", "e.pos", resolve_url(base_col, attr(F.col("e.attrs"), "href")).alias("link"))
