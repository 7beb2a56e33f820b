"""Article text from an HTML page.

Finding the article container, dropping noise subtrees and joining paragraph
text needs the page's element structure, which no built-in expression sees, so
this is one Arrow batch function over the page column.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.text import as_col

# --- fixed values: elements whose whole subtree is dropped -------------------
NOISE = frozenset(
    "nav aside footer header script style noscript iframe form button svg "
    "figure figcaption".split()
)
# --- fixed value: shorter extractions are discarded --------------------------
MIN_EXTRACT = 51

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# HTML lets these be left open; the start of another element closes them.
CLOSED_BY_P = frozenset("p b big s small strike tt u h1 h2 h3 h4 h5 h6".split())
ENDS_P = frozenset(
    "address blockquote center dd dir div dl dt h1 h2 h3 h4 h5 h6 hr li menu ol p pre table "
    "tbody td tfoot th tr ul".split()
)
CONTAINERS = ("article", "main", "role", "body")

NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
QUOTED = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style")}
MAIN_ROLE = re.compile(r"(?<![\w-])role\s*=\s*(?:\"main\"|'main'|main(?=[\s/]|\Z))", re.I)


class _Page:
    """Open elements of a page and, per container, the text found inside it."""

    def __init__(self) -> None:
        self.open: list[str] = []
        self.count: Counter[str] = Counter()
        self.noise_at: int | None = None
        # Depth at which the first element of each container kind is open.
        self.inside: dict[str, int] = {"body": 0}
        self.found: set[str] = set()
        self.paragraphs: dict[str, list[list[str]]] = {c: [] for c in CONTAINERS}
        self.texts: dict[str, list[str]] = {c: [] for c in CONTAINERS}
        self.open_paragraphs: list[tuple[int, list[str]]] = []
        self.in_head = 0

    def start(self, name: str, attributes: str) -> None:
        if name == "p":
            while self.open and self.open[-1] in CLOSED_BY_P:
                self._pop()
        elif name in ENDS_P and self.open and self.open[-1] == "p":
            self._pop()
        elif name == "li" and self.open and self.open[-1] == "li":
            self._pop()
        if name in VOID or name in ("html", "body"):
            return
        self.open.append(name)
        self.count[name] += 1
        depth = len(self.open)
        if self.noise_at is not None:
            return
        if name in NOISE or name in ("head", "title"):
            self.noise_at = depth
            return
        kinds = [name] if name in ("article", "main") else []
        if MAIN_ROLE.search(attributes):
            kinds.append("role")
        for kind in kinds:
            if kind not in self.found:
                self.found.add(kind)
                self.inside[kind] = depth
        if name == "p":
            pieces: list[str] = []
            for kind in self.inside:
                self.paragraphs[kind].append(pieces)
            self.open_paragraphs.append((depth, pieces))

    def end(self, name: str) -> None:
        if self.count[name]:
            while self._pop() != name:
                pass

    def text(self, raw: str) -> None:
        if self.noise_at is not None:
            return
        piece = entities.unescape(raw).strip()
        if not piece:
            return
        self.found.add("body")
        for kind in self.inside:
            self.texts[kind].append(piece)
        # The innermost one alone: paragraphs that are never closed nest without end.
        for _, pieces in self.open_paragraphs[-1:]:
            pieces.append(piece)

    def _pop(self) -> str:
        depth = len(self.open)
        if self.noise_at == depth:
            self.noise_at = None
        if self.open_paragraphs and self.open_paragraphs[-1][0] == depth:
            self.open_paragraphs.pop()
        for kind in [k for k, at in self.inside.items() if at == depth]:
            del self.inside[kind]
        self.count[self.open[-1]] -= 1
        return self.open.pop()

    def result(self) -> str | None:
        kind = next((c for c in CONTAINERS if c in self.found), None)
        if kind is None:
            return None
        if self.paragraphs[kind]:
            joined = "\n\n".join("".join(pieces) for pieces in self.paragraphs[kind])
        else:
            joined = "\n".join(self.texts[kind])
        joined = joined.strip()
        return joined if len(joined) >= MIN_EXTRACT else None


def extract_text(page: str | None) -> str | None:
    """The main text of one page, or None where there is too little of it."""
    if not page:
        return None
    state = _Page()
    for text, name, closing, attributes in _tokens(page):
        if text is not None:
            state.text(text)
        elif closing:
            state.end(name)
        else:
            state.start(name, attributes)
    return state.result()


def _tokens(page: str) -> Iterator[tuple[str | None, str, bool, str]]:
    """Text, or the name and attributes of a tag, in one pass that never turns back.

    A ``<`` that begins nothing is text. Without a ``>`` the rest is text; after a quote
    that is never closed, quotes no longer matter. Comments, declarations, scripts and
    style sheets are left out; unclosed, they reach to the end.
    """
    at, quotes = 0, True
    begin = page.find("<")
    while begin >= 0:
        until = begin + 1
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            until = len(page) if end < 0 else end + 3
            found = ("", False, "")
        elif page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            if end < 0:
                break
            until, found = end + 1, ("", False, "")
        elif named := NAME.match(page, begin):
            end = page.find(">", named.end())
            if end < 0:
                break
            if quotes and (whole := QUOTED.match(page, named.end())):
                end = whole.end() - 1
            else:
                quotes = False
            name, closing = named.group(1).lower(), page[begin + 1] == "/"
            until, found = end + 1, (name, closing, page[named.end() : end])
            if name in RAW_END and not closing:
                raw = RAW_END[name].search(page, until)
                until, found = (raw.end() if raw else len(page)), ("", False, "")
        else:
            begin = page.find("<", until)
            continue
        if begin > at:
            yield page[at:begin], "", False, ""
        at = until
        if found[0]:
            yield None, *found
        begin = page.find("<", at)
    if at < len(page):
        yield page[at:], "", False, ""


def extract_body(page: Column | str) -> Column:
    """Article text of an HTML column, NULL where nothing usable is found."""

    @F.arrow_udf(T.StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((extract_text(v) for v in batch.to_pylist()), pa.string())

    return run(as_col(page))


def cap_bytes(page: Column | str, limit: int) -> Column:
    """At most ``limit`` bytes of the page's UTF-8 form, as text."""
    raw = F.encode(as_col(page), "UTF-8")
    return F.when(F.octet_length(as_col(page)) <= limit, as_col(page)).otherwise(
        F.try_validate_utf8(F.substring(raw, 1, limit).cast("string"))
    )
