"""Facts of captured product pages: pairs of tables and definition lists, headings and links, each with the place it was found in."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template", "noscript"))
#: Elements that close an open one of their own kind.
CLOSES = {"tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "li": ("li",)}
FACT = ["kind", "key", "value", "evidence"]


class PageWalker(HTMLParser):
    """Emits (kind, key, value, evidence): `table` and `list` pairs, `heading` texts by level, `link` targets with the landmark they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.facts, self.open, self.counts = [], [], {}
        self.texts, self.cells, self.term = [], [], None

    def place(self, tag: str) -> str:
        self.counts[tag] = self.counts.get(tag, 0) + 1
        return f"{tag}[{self.counts[tag]}]"

    def inside(self, *tags: str) -> str | None:
        return next((t for t in reversed(self.open) if t in tags), None)

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        closing = CLOSES.get(tag, ())
        while self.open and self.open[-1] in closing:
            self.handle_endtag(self.open[-1])
        if tag == "a" and named.get("href"):
            self.facts.append(("link", self.inside("nav", "header", "footer", "main", "article", "aside") or "", named["href"], self.place("a")))
        if tag == "tr":
            self.cells, self.row = [], self.place("tr")
        if tag == "dl":
            self.term = None
        if tag in ("td", "th", "dt", "dd", "h1", "h2", "h3"):
            self.texts.append([])
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        while self.open:
            own = self.open.pop()
            self.left(own)
            if own == tag:
                return

    def left(self, tag: str) -> None:
        text = " ".join("".join(self.texts.pop()).split()) if tag in ("td", "th", "dt", "dd", "h1", "h2", "h3") and self.texts else ""
        if tag in ("td", "th"):
            self.cells.append(text)
        elif tag == "tr" and self.cells:
            key, *values = self.cells
            self.facts.append(("table", key.rstrip(":").rstrip(), " | ".join(values), f"{self.row}/{len(self.cells)}"))
            self.cells = []
        elif tag == "dt":
            self.term = text
        elif tag == "dd":
            self.facts.append(("list", (self.term or "").rstrip(":").rstrip(), text, self.place("dd")))
        elif tag in ("h1", "h2", "h3"):
            self.facts.append(("heading", tag, text, self.place(tag)))

    def handle_data(self, data):
        if not self.inside(*SILENT):
            for own in self.texts:
                own.append(data)

    def done(self) -> list[tuple]:
        """All facts, once the page is at its end."""
        self.goahead(True)
        while self.open:
            self.left(self.open.pop())
        return self.facts


def page_facts(pages: DataFrame, keys: list[str], html: str = "html", references: bool = True) -> DataFrame:
    """keys, position, kind, key, value, evidence: a row for each fact of a page, in page order; null and empty pages have none.

    references: character references are decoded, those without a semicolon
    too; otherwise texts and link targets keep them as they are written.
    """
    kinds = dict(pages.dtypes)

    def run(batches):
        for batch in batches:
            at, position, out = [], [], []
            for k, own in enumerate(batch.column("_html").to_pylist()):
                walker = PageWalker()
                own = own or ""
                # a reference to the sign itself keeps what follows as it is written
                walker.feed(own if references else own.replace("&", "&amp;"))
                facts = walker.done()
                at += [k] * len(facts)
                position += range(len(facts))
                out += facts
            yield pa.RecordBatch.from_pydict({c: batch.column(f"_k_{c}").take(pa.array(at, pa.int64())) for c in keys} | {"position": pa.array(position, pa.int32())} | {c: pa.array([f[j] for f in out], pa.string()) for j, c in enumerate(FACT)})

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), "position int", *(f"{c} string" for c in FACT)])
    return pages.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.col(html).alias("_html")).mapInArrow(run, schema)


def row_fault(pairs: Column, expected: Column, article: tuple[str, ...] = ("número del artículo", "número de artículo")) -> Column:
    """Why the pairs (array of key, value, cells) of a page are no details of the expected product; null where they are."""
    odd = F.exists(pairs, lambda p: p["cells"] != 2)
    blank = F.exists(pairs, lambda p: (F.trim(p["key"]) == "") | (F.trim(p["value"]) == ""))
    own = F.transform(F.filter(pairs, lambda p: F.lower(p["key"]).isin(*article)), lambda p: F.trim(p["value"]))
    wrong = (own != F.array(expected)) | (F.size(pairs) < 2)
    return F.when(odd, "ROW_SHAPE_INVALID").when(blank, "EMPTY_CELL").when(F.coalesce(wrong, F.lit(True)), "ARTICLE_ID_MISMATCH")


def verified_details(facts: DataFrame, key: str, expected: Column) -> DataFrame:
    """(key, details, fault): the table rows of each page as `key: value; …`, if they are whole and name the expected product."""
    rows = facts.where("kind = 'table'").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("position", F.col("key").alias("key"), "value", F.split("evidence", "/")[1].cast("int").alias("cells")))).alias("_pairs"))
    fault = row_fault(F.col("_pairs"), expected)
    joined = F.array_join(F.transform("_pairs", lambda p: F.concat(p["key"], F.lit(": "), p["value"])), "; ")
    return rows.select(key, F.when(fault.isNull(), joined).alias("details"), fault.alias("fault"))
