"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree. A page's elements become element nodes
(a place in the sequence of the parent's children), each sequence of child styles below
an element node a style node; keys are hashes along the path, so pages merge by grouping
rows and no host's tree is ever in one place. Over the distinct pages of the host:

* an element node without children of its own has the importance of its contents,
  ``1 - mean entropy`` of the texts under it: a text that all pages share has entropy 1,
  one that stands in a single page 0;
* an element node with ``l`` style nodes has presentation importance
  ``-sum p log_m p`` over the shares ``p`` of its style nodes in its ``m`` pages, and the
  composite importance ``(1 - 0.9^l) * presentation + 0.9^l * children's mean``.

A branch is of low importance where it and all elements below it stay under
``THRESHOLD``; it is removed from every page of the host. Hosts, and nodes, of fewer than
``MIN_PAGES`` distinct pages say nothing and lose nothing.

Entropy alone can't tell a menu of ever new words from an article, nor an article that
several pages carry from a notice. So the importance of a presentation node is fixed
where its style has a telling name (see :mod:`docflow.llm.dom`): none for menus,
footers, sidebars, notices, adverts, forms and comments, and within an ``article`` (else
``main``, else a block named as content) only branches that have a style of their own go by
their entropy. Where a page has such a container, text outside it is no article.

Every page is read twice: for the tree's rows and for its text. The rows (a few numbers
per element and block) are what is shuffled, distinct by page digest; a hot host's rows
differ by node and page, so they spread. The low branches of a host reach its pages by a
broadcast of a checked size, else by a join on host and a salt of the page.

Defined results: null and empty html give empty text; markup that holds no text too;
pages without a host in their url are extracted by style names alone; repeated pages
count once for their host and keep a row each; other columns stay, whatever they are
called, but for ``text`` and ``n_chars``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.session import materialize, size_checked

from .dom import Page

THRESHOLD, MIN_PAGES, DAMPING = 0.25, 5, 0.9
SALTS, MAX_BROADCAST = 64, 200_000
_NODE, _STYLE, _TEXT = 0, 1, 2


def host_of(url: Column) -> Column:
    """The url's host in lower case, null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _site(host: str) -> int:
    """As Spark's ``xxhash64`` of the host has it (seed 42), unsigned."""
    return xxhash.xxh64_intdigest(host, seed=42)


def _site_column(host: Column) -> Column:
    return F.xxhash64(host)


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its distinct rows ``(site, node, kind, sub, size, page)``: nodes (sub: the style
    node above, size: the level), style nodes (sub; size: their children) and texts (sub)."""
    for batch in batches:
        rows: list[tuple] = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            site, page, digest = _site(host), Page(html), xxhash.xxh64_intdigest(html)
            _, nodes, styles, texts = page.keys(site)
            held = {(at, _NODE, above, level) for at, above, level in nodes}
            held |= {(above, _STYLE, here, size) for here, above, size in styles}
            held |= {(at, _TEXT, xxhash.xxh64_intdigest(text), 0) for at, (_, text) in zip(texts, page.blocks, strict=True)}
            rows += [(_signed(site), _signed(at), kind, _signed(sub), size, _signed(digest)) for at, kind, sub, size in held]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


_NAMES = ["site", "node", "kind", "sub", "size", "page"]
_TYPES = (pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int32(), pa.int64())


def low_branches(pages: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(site, node)``: the element nodes of low importance with all below them, of
    ``pages (host, html)``."""
    rows = pages.mapInArrow(_tree_rows, "site long, node long, kind byte, sub long, size int, page long")
    counts = materialize(rows.distinct().groupBy("site", "node", "kind", "sub", "size").agg(F.count(F.lit(1)).alias("n")), "style-tree")
    kind, log_n = F.col("kind"), F.log(F.col("n").cast("double"))

    def total(of: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(kind == of, value)), F.lit(0.0))

    nodes = counts.groupBy("site", "node").agg(
        F.max(F.when(kind == _NODE, F.col("size"))).alias("level"),
        F.max(F.when(kind == _NODE, F.col("sub"))).alias("above"),
        total(_NODE, F.col("n")).alias("m"),
        F.count_if(kind == _STYLE).alias("styles"),
        F.greatest(total(_STYLE, F.col("n")), F.lit(1.0)).alias("shown"),
        total(_STYLE, F.col("n") * log_n).alias("n_log_n"),
        F.count_if(kind == _TEXT).alias("texts"),
        total(_TEXT, log_n).alias("log_texts"),
    )
    many, log_m = F.col("m") > 1, F.log("m")
    presentation = F.when(many, F.least(F.lit(1.0), (F.log("shown") - F.col("n_log_n") / F.col("shown")) / log_m)).otherwise(1.0)
    content = F.when(many, 1 - F.col("log_texts") / F.greatest("texts", F.lit(1)) / log_m).otherwise(1.0)
    nodes = materialize(nodes.select("site", "node", "level", "above", "m", "styles", "texts", "shown", presentation.alias("p"), content.alias("c")), "nodes")
    styles = counts.where(kind == _STYLE).select(F.col("sub").alias("above"), F.col("node").alias("parent"), "n", F.col("size").alias("k"))
    below, low = None, None
    # from the deepest level up (14 levels at most): each reads the nodes of one level only
    for level in range(nodes.agg(F.max("level")).first()[0] or 0, -1, -1):
        here = nodes.where(F.col("level") == level)
        if below is None:
            here = here.withColumns({"children": F.lit(0.0), "most": F.lit(0.0)})
        else:
            sums = below.groupBy("above").agg(F.sum("importance").alias("sum"), F.max("most").alias("most"))
            share = F.col("n") * F.col("sum") / F.col("k")
            by_parent = styles.join(sums, "above").groupBy(F.col("parent").alias("node")).agg(F.sum(share).alias("children"), F.max("most").alias("most"))
            here = here.join(by_parent, "node", "left").fillna(0.0, ["children", "most"])
        rest = F.pow(F.lit(DAMPING), F.col("styles"))
        composite = (1 - rest) * F.col("p") + rest * F.col("children") / F.col("shown")
        importance = F.when(F.col("texts") > 0, F.col("c")).otherwise(composite)
        scored = here.select("site", "node", "above", "m", "texts", importance.alias("importance"), "most")
        # texts have no verdict of their own: their element's holds for them
        most = F.when(F.col("texts") > 0, 0.0).otherwise(F.greatest("importance", "most"))
        below = materialize(scored.withColumn("most", most), f"importance-{level}")
        found = below.where((F.col("texts") == 0) & (F.col("most") < threshold) & (F.col("m") >= min_pages)).select("site", "node")
        low = found if low is None else low.unionByName(found)
    return low


def _texts(low_of_all: frozenset | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.schema.names, []
            lows = batch.column("low").to_pylist() if "low" in names else [None] * batch.num_rows
            for host, html, low in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), lows, strict=True):
                page = Page(html)
                low = low_of_all if low_of_all is not None else frozenset(low or ())
                node = [_signed(x) for x in page.keys(_site(host))[0]] if low and host else None
                texts.append(page.main_text(node, low))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return run


def extract_main_text(
    pages: DataFrame, *, html_col: str = "html", url_col: str = "url", threshold: float = THRESHOLD, min_pages: int = MIN_PAGES,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``pages`` with ``text`` (the article, blocks joined by an empty line) and ``n_chars``
    (its code points)."""
    host, html = host_of(F.col(f"`{url_col}`")), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    low = low_branches(pages.select(host.alias("host"), html.alias("html")).where("host IS NOT NULL AND html <> ''"), threshold, min_pages)
    low, small = size_checked(low, max_broadcast)
    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    row = F.struct(F.lit(True).alias("any"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    asked = pages.select(row.alias("row"), host.alias("host"), html.alias("html"))
    held = None
    if small:
        held = frozenset(r["node"] for r in low.select("node").collect())
    else:  # a hot host's pages go to many tasks, each with the host's low branches
        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
        of_site = low.groupBy(F.col("site").alias("of")).agg(F.collect_set("node").alias("low"))
        of_site = of_site.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asked = asked.withColumn("salt", salt).withColumn("site", _site_column(F.col("host")))
        asked = asked.join(of_site.hint("merge"), (F.col("site") == F.col("of")) & (F.col("salt") == F.col("at")), "left").select("row", "host", "html", "low")
    schema = T.StructType([asked.schema["row"], T.StructField("text", T.StringType())])
    out = asked.mapInArrow(_texts(held), schema)
    columns = [F.col("row").getField(f"c{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*columns, "text", F.length("text").cast("long").alias("n_chars"))
