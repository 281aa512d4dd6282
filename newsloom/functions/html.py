"""HTML extraction and paragraph splitting as Arrow passes over whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

BODY_CHARS, IMAGES, LEAST_PIXELS, PARAGRAPH_CHARS = 8000, 10, 120, 400
_SKIPPED = {"script", "style", "noscript", "svg", "nav", "aside", "footer", "header", "form"}
_VOID = {"br", "img", "meta", "link", "input", "hr", "source", "wbr"}


class _Page(HTMLParser):
    """Title, meta tags, paragraphs outside links and menus, and images of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.title, self.paragraphs, self.images = "", [], []
        self._skip = self._link = 0
        self._in_title = False
        self._text: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag in _SKIPPED:
            self._skip += 1
        elif tag == "a":
            self._link += 1
        elif tag == "title":
            self._in_title = True
        elif tag == "meta":
            name = a.get("property") or a.get("name")
            if name:
                self.meta.setdefault(name, a.get("content", ""))
        elif tag == "p" and not self._skip:
            self._close()
            self._text = []
        elif tag == "br" and self._text is not None:
            self._text.append(" ")
        elif tag == "img" and not self._skip:
            source = a.get("src") or a.get("data-src") or a.get("srcset", "").split(" ")[0]
            small = any(v.isdigit() and int(v) < LEAST_PIXELS for v in (a.get("width", ""), a.get("height", "")))
            if source and not small and source not in self.images:
                self.images.append(source)

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIPPED:
            self._skip = max(0, self._skip - 1)
        elif tag == "a":
            self._link = max(0, self._link - 1)
        elif tag == "title":
            self._in_title = False
        elif tag in ("p", "article", "body"):
            self._close()

    def handle_data(self, data: str) -> None:
        if self._in_title:
            self.title += data
        elif self._text is not None and not self._skip and not self._link:
            self._text.append(data)

    def _close(self) -> None:
        if self._text is not None:
            text = " ".join("".join(self._text).split())
            if text:
                self.paragraphs.append(text)
        self._text = None


def parse(html: str | None) -> dict:
    page = _Page()
    page.feed(html or "")
    page.close()
    page._close()
    body = "\n\n".join(page.paragraphs)[:BODY_CHARS]
    return {"title": page.meta.get("og:title") or page.title.strip(), "og_image": page.meta.get("og:image"), "n_paragraphs": len(page.paragraphs), "n_images": min(len(page.images), IMAGES), "body_chars": len(body), "body": body}


def extract(pages: DataFrame, key: str) -> DataFrame:
    """key, title, og_image, n_paragraphs, n_images, body_chars and body of each page's html."""
    kind = pages.schema[key].dataType.simpleString()
    names = ["title", "og_image", "n_paragraphs", "n_images", "body_chars", "body"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [parse(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), *(pa.array([f[n] for f in found], t) for n, t in zip(names, types, strict=True))], names=[key, *names])

    return pages.mapInArrow(run, f"{key} {kind}, title string, og_image string, n_paragraphs int, n_images int, body_chars int, body string")


_END = re.compile(r"(?<=[.!?])\s+")


def split_paragraphs(text: str | None, longest: int = PARAGRAPH_CHARS) -> list[str]:
    """Blocks of a text; longer ones are cut greedily between sentences."""
    out: list[str] = []
    for block in re.split(r"\n+", text or ""):
        block = block.strip()
        if len(block) <= longest:
            out += [block] if block else []
            continue
        held = ""
        for sentence in _END.split(block):
            if held and len(held) + 1 + len(sentence) > longest:
                out.append(held)
                held = sentence
            else:
                held = f"{held} {sentence}" if held else sentence
        out.append(held)
    return out


def paragraphs(docs: DataFrame, key: str) -> DataFrame:
    """key, n_paragraphs and the longest paragraph's length."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [split_paragraphs(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([len(p) for p in parts], pa.int32()), pa.array([max(map(len, p), default=0) for p in parts], pa.int32())], names=[key, "n_paragraphs", "longest"])

    return docs.mapInArrow(run, f"{key} {kind}, n_paragraphs int, longest int")
