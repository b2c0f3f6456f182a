"""Splittable scans of large XML files (SRC-3, XML-9, XML-13).

A file is read as text whose line separator is the record's closing tag, so Spark cuts it
into splits of ``maxPartitionBytes`` and every record belongs to one split, wherever the
cut falls. Two things can make a closing tag no end of a record: a comment or a CDATA
section around it. Which state (text, comment, CDATA) a split begins in depends on the
splits before it, so a first pass reads of every split only the pieces that hold one of
those marks and returns how the split maps the three states; the maps of a file's splits
are composed in order (one small row per split that has marks, none for plain files).

* :func:`scan_records`: one row per record. Plain files stay in the JVM: the text before a
  record's start tag is cut off, the closing tag put back. Files with marks, with records
  without content (``<r/>``) or with blanks in closing tags go through one Arrow pass that
  walks each split in order; the few records that lie across splits inside a mark are put
  together from their pieces.
* :func:`scan_chunks`: documents of any size as small documents. A document's start (its
  fields up to the first record) is carried to every chunk of its records, within a split
  as it is read and from split to split by the first pass, so no task holds more than a
  chunk and no document needs to fit a row. What follows the last record stands in the
  document's last chunk.

Records and documents of their own name inside one another are not supported. Files are
UTF-8 (or given ``encoding``'s ASCII-compatible text).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MARK = re.compile(r"<!--|-->|<!\[CDATA\[|\]\]>")
_SECTION = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>", re.S)
TEXT, COMMENT, CDATA = 0, 1, 2
_OPENS, _CLOSES = {"<!--": COMMENT, "<![CDATA[": CDATA}, {COMMENT: "-->", CDATA: "]]>"}
_TAG = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""


def _has_mark(value: Column) -> Column:
    """Plain text searches: most pieces have none, and each costs one scan of the piece."""
    return value.contains("<!--") | value.contains("-->") | value.contains("<![CDATA[") | value.contains("]]>")


def state_after(text: str, state: int) -> int:
    """The state (text, inside a comment, inside CDATA) after ``text``."""
    for m in _MARK.finditer(text):
        if state == TEXT:
            state = _OPENS.get(m.group(), TEXT)
        elif m.group() == _CLOSES[state]:
            state = TEXT
    return state


def _masked(text: str) -> str:
    """``text`` with comments, CDATA sections and instructions blanked, at equal length."""
    if "<!" not in text and "<?" not in text:
        return text
    return _SECTION.sub(lambda m: " " * len(m.group()), text)


def _pieces(spark: SparkSession, path: str, tag: str, encoding: str | None) -> DataFrame:
    """``(path, block, value)``: the file's text cut at the closing tags, each split's in order."""
    reader = spark.read.option("lineSep", f"</{tag}>")
    if encoding:
        reader = reader.option("encoding", encoding)
    meta = F.col("_metadata")
    return reader.text(path).select(meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), "value")


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    """((path, block), text) of every piece, in the order of the scan."""
    for b in batches:
        yield from zip(zip(b.column("path").to_pylist(), b.column("block").to_pylist(), strict=True), b.column("value").to_pylist(), strict=True)


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_STATES = pa.schema([("path", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.int32())), ("start", pa.string()), ("inside", pa.bool_())])


def _split_maps(tag: str, doc_tag: str | None):
    """Per split that has any: the state it maps each state to, and of documents the last
    start (fields up to the first record) and whether the split ends inside a document."""

    def run(batches):
        key, ends, start, inside = None, [], None, None
        for here, text in _batched(batches):
            if here != key:
                if key:
                    yield _out([(*key, ends, start, inside)], _STATES)
                key, ends, start, inside = here, [TEXT, COMMENT, CDATA], None, None
            if _MARK.search(text):
                ends = [state_after(text, e) for e in ends]
            if doc_tag:
                for m in re.finditer(rf"<{doc_tag}(?=[\s/>]){_TAG}>|</{doc_tag}\s*>", _masked(text)):
                    inside = not m.group().startswith("</") and not m.group().endswith("/>")
                    if inside:
                        first = re.search(rf"<{tag}(?=[\s/>])", _masked(text[m.start() :]))
                        start = text[m.start() : m.start() + first.start()] if first else text[m.start() :]
        if key:
            yield _out([(*key, ends, start, inside)], _STATES)

    return run


def _by_split(pieces: DataFrame, wanted: Column, tag: str, doc_tag: str | None = None) -> list:
    """The maps of all splits that hold a wanted piece, in order of path and place. As many
    rows as splits at most, which is what the driver already lists to plan the scan."""
    found = pieces.where(wanted).mapInArrow(_split_maps(tag, doc_tag), "path string, block long, ends array<int>, start string, inside boolean")
    return sorted(found.collect(), key=lambda r: (r["path"], r["block"]))


def _marked(maps: list) -> list[tuple[str, int, int, int]]:
    """``(path, block, state at its start, state at its end)`` of the splits of ``maps``;
    splits in between keep the state."""
    out, path, state = [], None, TEXT
    for r in maps:
        if r["path"] != path:
            path, state = r["path"], TEXT
        out.append((path, r["block"], state, r["ends"][state]))
        state = r["ends"][state]
    return out


class _Units:
    """A split's pieces joined to units that end at true closing tags.

    ``walk`` yields ``((path, block), kind, text)``: whole units, the ``head`` of a split
    that begins inside a mark, and the ``tail`` of one that ends inside a mark."""

    def __init__(self, tag: str, marked: list[tuple[str, int, int, int]]):
        self.close = f"</{tag}>"
        self.marked = marked  # (path, block, state at its start, state at its end) of splits with marks

    def begins(self, key: tuple[str, int]) -> int:
        state = TEXT
        for path, block, start, end in self.marked:
            if path == key[0] and block <= key[1]:
                state = start if block == key[1] else end
        return state

    def walk(self, batches) -> Iterator[tuple[tuple[str, int], str, str]]:
        key, state, held, head = None, TEXT, [], False
        for here, text in _batched(batches):
            if here != key:
                if held:
                    yield key, "head" if head else "tail", "".join(held)
                key, held = here, []
                state = self.begins(here)
                head = state != TEXT
            text += self.close
            held.append(text)
            if state != TEXT or "<!" in text:
                state = state_after(text, state)
            if state == TEXT:
                yield key, "head" if head else "unit", "".join(held)
                held, head = [], False
        if held:
            yield key, "head" if head else "tail", "".join(held)


def records_in(unit: str, tag: str) -> list[str]:
    """The records of a unit: from each start tag to its closing tag."""
    masked, out, at = _masked(unit), [], 0
    start = re.compile(rf"<{tag}(?=[\s/>]){_TAG}(/?)>")
    close = re.compile(rf"</{tag}\s*>")
    while m := start.search(masked, at):
        if m.group(1):
            at = m.end()
        else:
            end = close.search(masked, m.end())
            if not end:
                break
            at = end.end()
        out.append(unit[m.start() : at])
    return out


_RECORD = pa.schema([("path", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("xml", pa.string())])


def _records(tag: str, marked: list):
    def run(batches):
        rows, size = [], 0
        for (path, block), kind, text in _Units(tag, marked).walk(batches):
            found = records_in(text, tag) if kind == "unit" else [text]
            rows += [(path, block, kind, x) for x in found]
            size += len(text)
            if size > 1 << 22:
                yield _out(rows, _RECORD)
                rows, size = [], 0
        yield _out(rows, _RECORD)

    return run


def _glued(tag: str):
    def run(batches):
        for b in batches:
            rows = [(None, None, "unit", x) for text in b.column("text").to_pylist() for x in records_in(text, tag)]
            yield _out(rows, _RECORD)

    return run


def scan_records(spark: SparkSession, path: str, tag: str, *, encoding: str | None = None) -> DataFrame:
    """``(xml)``: every ``tag`` element of the files as a document of its own."""
    if not re.fullmatch(r"[^\W\d][\w.\-:]*", tag):
        raise ValueError(f"no element name: {tag!r}")
    pieces = _pieces(spark, path, tag, encoding)
    value = F.col("value")
    start = rf"<{tag}[\s/>]"
    # pieces of other than one start tag with content, or with a closing tag left in them; the
    # text searches in front of the patterns spare most pieces those
    begin = F.lit(f"<{tag}")
    again = F.position(begin, value, F.position(begin, value) + 1) > 0
    twice = again & value.rlike(rf"(?s){start}.*{start}")
    empty = value.contains("/>") & value.rlike(rf"<{tag}(\s[^<>]*)?/>")
    unusual = twice | empty | (value.contains(f"</{tag}") & value.rlike(rf"</{tag}\s"))
    marks = _by_split(pieces, _has_mark(value) | unusual, tag)
    if not marks:
        at = F.regexp_instr(value, F.lit(start))
        cut = F.when(at > 0, F.substr(value, at)).otherwise(F.lit(""))
        return pieces.select(cut.alias("xml")).where(F.col("xml") != "").select(F.concat("xml", F.lit(f"</{tag}>")).alias("xml"))
    marked = _marked(marks)
    found = pieces.mapInArrow(_records(tag, marked), "path string, block long, kind string, xml string")
    whole = found.where("kind = 'unit'").select("xml")
    if all(end == TEXT for *_, end in marked):
        return whole
    # a record across splits: the tail of one and the heads of the next ones, up to where the
    # mark ends; two rows a split at most
    later = F.col("kind") == "tail"
    before = Window.partitionBy("path").orderBy("block", later)
    parts = found.where("kind <> 'unit'").withColumn("chain", F.last(F.when(later, F.col("block")), ignorenulls=True).over(before))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", later, "xml"))), lambda s: s["xml"]), "")
    glued = parts.groupBy("path", "chain").agg(text.alias("text")).select("text")
    return whole.unionByName(glued.mapInArrow(_glued(tag), "path string, block long, kind string, xml string").select("xml"))


_CHUNK = pa.schema([("path", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_()), ("xml", pa.string())])


def open_tags(text: str) -> list[str]:
    """Names of the elements that ``text`` opens and does not close."""
    out: list[str] = []
    for m in re.finditer(rf"<(/?)([^\s<>/!?]+){_TAG}(/?)>", _masked(text)):
        if m.group(1):
            while out and out.pop() != m.group(2):
                pass
        elif not m.group(3):
            out.append(m.group(2))
    return out


def _chunks(doc_tag: str, tag: str, marked: list, carried: list[tuple[str, int, str | None]], rows_per_chunk: int):
    doc_start, doc_end = re.compile(rf"<{doc_tag}(?=[\s/>]){_TAG}(/?)>"), re.compile(rf"</{doc_tag}\s*>")
    row_start, row_end = re.compile(rf"<{tag}(?=[\s/>])"), re.compile(rf"</{tag}\s*>")
    empty_row = re.compile(rf"<{tag}(?=[\s/>]){_TAG}/>")

    class Document:
        """The document that is being read: its start, and the rows of the next chunk."""

        def __init__(self, start: str, fresh: bool):
            self.start, self.fresh = start, fresh
            self.depth = open_tags(start)
            self.closers = "".join(f"</{t}>" for t in reversed(self.depth))
            self.rows, self.between, self.n = [], False, 0

        def add(self, text: str) -> None:
            self.rows.append(text)
            self.n += 1

        def even(self) -> bool:
            """May a chunk end here? Not where the group was closed and opened otherwise."""
            return not self.between or open_tags(self.start + "".join(self.rows)) == self.depth

    def run(batches):
        out, key, seq, doc = [], None, 0, None

        def emit(closing: str, last: bool) -> None:
            nonlocal seq
            out.append((*key, seq, doc.fresh, last, doc.start + "".join(doc.rows) + closing))
            seq += 1
            doc.rows, doc.n, doc.fresh, doc.between = [], 0, False, False

        for here, kind, unit in _Units(tag, marked).walk(batches):
            if kind != "unit" and (kind == "head" or row_start.search(unit)):
                raise ValueError(f"{here[0]}: a split ends inside a comment or CDATA section; raise spark.sql.files.maxPartitionBytes")
            if here != key:
                if doc and doc.n:
                    emit(doc.closers, False)
                key, seq = here, 0
                start = None
                for path, block, text in carried:
                    if path == key[0] and block < key[1]:
                        start = text
                doc = Document(start, False) if start else None
            masked, at = _masked(unit), 0
            while at < len(unit):
                # up to the next row, documents may end and begin
                row = row_start.search(masked, at)
                stop = row.start() if row else len(unit)
                while True:
                    if doc:
                        end = doc_end.search(masked, at, stop)
                        if not end:
                            break
                        emit(unit[at : end.end()], True)
                        doc, at = None, end.end()
                    begin = doc_start.search(masked, at, stop)
                    if not begin:
                        break
                    if begin.group(1):
                        out.append((*key, seq, True, True, begin.group()))
                        seq, at = seq + 1, begin.end()
                        continue
                    end = doc_end.search(masked, begin.end(), stop)
                    doc = Document(unit[begin.start() : stop if not end else begin.end()], True)
                    at = stop if not end else begin.end()
                if not row:
                    break
                if doc and at < stop and unit[at:stop].strip():
                    doc.between = True
                close = empty_row.match(masked, stop) or row_end.search(masked, stop)
                if not close:
                    break  # after the last record of the file
                end = close.end()
                if doc:
                    doc.add(unit[at:end])
                    if doc.n >= rows_per_chunk and doc.even():
                        emit(doc.closers, False)
                at = end
            if len(out) >= 64:
                yield _out(out, _CHUNK)
                out = []
        if doc and doc.n:
            emit(doc.closers, False)
        yield _out(out, _CHUNK)

    return run


def scan_chunks(spark: SparkSession, path: str, doc_tag: str, tag: str, *, rows: int = 1_000, encoding: str | None = None) -> DataFrame:
    """``(path, block, seq, first, last, xml)``: the documents ``doc_tag`` of the files, each as
    chunks that repeat the document's start and hold up to ``rows`` of its records ``tag``
    (in order of ``block`` and ``seq`` within a file); every chunk is well-formed. ``first``
    marks a document's first chunk, ``last`` the one with what follows the records."""
    for name in (doc_tag, tag):
        if not re.fullmatch(r"[^\W\d][\w.\-:]*", name):
            raise ValueError(f"no element name: {name!r}")
    pieces = _pieces(spark, path, tag, encoding)
    value = F.col("value")
    maps = _by_split(pieces, _has_mark(value) | value.rlike(rf"</?{doc_tag}[\s/>]"), tag, doc_tag)
    marked = [m for m in _marked(maps) if m[2:] != (TEXT, TEXT)]
    carried = [(r["path"], r["block"], r["start"] if r["inside"] else None) for r in maps if r["inside"] is not None]
    schema = "path string, block long, seq long, first boolean, last boolean, xml string"
    return pieces.mapInArrow(_chunks(doc_tag, tag, marked, carried, rows), schema)
