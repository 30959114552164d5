"""Main text of web pages by deducing each host's template.

A page's tokens are its container tags with their path and its text blocks with theirs, in page order. A token's occurrence
vector says how often it occurs on each page of the host; it is summed into one order-free hash, so tokens
with equal vectors form an equivalence class without bringing a host's pages together. Classes that
are large (two tokens and more) and frequent (half of the host's pages, ``MIN_PAGES`` at least) are made valid:
ordered, as they are cut where a token has not the same successor everywhere, and nested, as of two classes
that cross on a page the smaller one goes. Then the same token in different gaps of a class is told apart as different
roles, which have vectors of their own, and classes are formed again, until a host's template grows no more.

The template's text blocks are dropped; what remains are the slots between the template's tokens. Slots nested in
menus, headers, footers and the like are dropped by their container. Text inside an article or main container is never
template, and only that container's slots are kept, unless ``TEASER`` times as much text remains beside it.

Html is read in one pass, with optional end tags: an open head ends at the first element or text that cannot be in it,
a hidden element without an end tag of its own at the next block, other open elements with their ancestors; an open
script, style, title or textarea runs to the end of the page. After one tag whose quotes never close, tags end at
their first ">". Classes decide for block elements; an inline element is dropped for being hidden or for its role,
and breaks no block.

Null html gives an empty text, a null or odd url the host "" (such pages share one template); repeated rows are
pages like any other; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from caselake.llm.store import write_out

MIN_PAGES = 5
SALT = 64
TEASER = 3
# Elements by what they mean for the text.
RAW = {"script", "style", "title", "textarea"}
HIDDEN = {"noscript", "template", "iframe", "object", "svg", "math", "head", "select", "button", "canvas", "audio", "video"} | RAW
IN_HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
OUTSIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
CONTAINERS = {"html", "body", "div", "section", "article", "main", "header", "ul", "ol", "dl", "table", "tbody", "thead", "tr", "center", "details", "figure"} | OUTSIDE
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "blockquote", "pre", "address", "hr", "figcaption", "caption", "summary", "title"}
ENDED_BY_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
ENDED_BY_THEIR_LIKE = {"li", "dt", "dd", "td", "th", "button", "select"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|sidebar|aside|footer|masthead|ad|ads|advert|advertisement|adsense|banner|promo|sponsor|sponsored|"
    r"cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|"
    r"related|recommended|breadcrumb|breadcrumbs|comment|comments|commentlist|reply|replies|disqus|widget|toolbar|pagination|pager)(?:$|[\s_-])"
    # Words of ordinary names too: only where they end a name.
    r"|(?:^|[\s_-])(?:side|foot|discussion|tags|toc)(?:$|\s)", re.I)
_HEADER = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-header|page-header)(?:$|[\s_-])", re.I)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar", "form"}
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"((?:\"[^\"]*\"|'[^']*'|[^>\"']++)*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SEQUENCES = "page_id long, url string, host string, page long, tokens array<long>, texts array<string>, main array<boolean>"
_PLACES = "array<struct<role:bigint,class:bigint,place:int,size:int>>"


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name.lower(), "".join(values)) for name, *values in _ATTRIBUTE.findall(text)] if text else []


def _noisy(tag: str, attributes: list[tuple[str, str]], inside_main: bool) -> bool:
    if tag in OUTSIDE or tag in HIDDEN or (tag == "header" and not inside_main):
        return True
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "role" and value.lower() in _ROLES):
            return True
        if name in ("class", "id") and tag in BLOCKS and tag not in ("html", "body", "article", "main") and (
                _NOISE.search(value) or (not inside_main and _HEADER.search(value))):
            return True
    return False


def _is_main(tag: str, attributes: list[tuple[str, str]]) -> bool:
    return tag in ("article", "main") or any(n == "role" and v.lower() == "main" for n, v in attributes)


def parts(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """(text before, closing?, tag, attributes) of every tag in order, the rest of the text with tag "" at last. One pass."""
    at, begun, quoted = 0, 0, True
    while (at := page.find("<", at)) >= 0:
        text, name = page[begun:at], _NAME.match(page, at)
        if name is None:
            for start, end in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
                if page.startswith(start, at):
                    stop = page.find(end, at + len(start))
                    at = begun = len(page) if stop < 0 else stop + len(end)
                    yield text, False, "!", ""
                    break
            else:
                at += 1
            continue
        rest = _REST.match(page, name.end()) if quoted else None
        stop = rest.end() if rest else page.find(">", name.end()) + 1
        if not stop:
            break
        quoted = quoted and rest is not None
        at = begun = stop
        tag = name[2].lower()
        yield text, bool(name[1]), tag, page[name.end():stop - 1]
        if tag in RAW and not name[1] and page[stop - 2] != "/":
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = begun = end.end() if end else len(page)
    yield page[begun:], False, "", ""


def blocks(page: str) -> list[tuple[str, str | None, bool]]:
    """(path, text, inside main?) of every visible block and, without a text, of every container that opens, in page order."""
    out = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, noisy, main, ended by the next block
    held: list[str] = []
    found = list(parts(page))
    # For each hidden or inline start tag: does its own end tag come before another start of its kind?
    ends, last = [False] * len(found), {}
    for i in range(len(found) - 1, -1, -1):
        _, closing, tag, _ = found[i]
        ends[i] = last.get(tag, False)
        last[tag] = closing

    def state() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((">".join(s[0] for s in stack if s[0] in CONTAINERS), text, state()[1]))

    def leave(tag: str) -> None:
        names = [s[0] for s in stack]
        if tag in names:
            del stack[len(names) - 1 - names[::-1].index(tag):]

    for i, (text, closing, tag, written) in enumerate(found):
        if stack and stack[-1][0] == "head" and text.strip():
            stack.pop()
        if not state()[0]:
            held.append(text)
        if tag in ("", "!") or (tag in RAW and not closing):
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCKS:
            flush()
        if closing:
            leave(tag)
            continue
        if tag == "body" or (stack and stack[-1][0] == "head" and tag not in IN_HEAD):
            leave("head")
        while stack and ((tag in BLOCKS and (stack[-1][3] or stack[-1][0] in ENDED_BY_BLOCKS)) or (tag == stack[-1][0] and tag in ENDED_BY_THEIR_LIKE)):
            stack.pop()
        if tag in VOID or written.endswith("/"):
            continue
        noisy, main = state()
        attributes = _attributes(written)
        drops = _noisy(tag, attributes, main)
        if tag in CONTAINERS or drops or (noisy and any(s[0] == tag for s in stack)):
            stack.append((tag, noisy or drops, main or _is_main(tag, attributes), tag not in BLOCKS and tag != "head" and not ends[i]))
            if tag in CONTAINERS:
                out.append((">".join(s[0] for s in stack if s[0] in CONTAINERS), None, state()[1]))
    flush()
    return out


def _hash(kind: str, path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}") - (1 << 63)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.bool_()))
    for batch in batches:
        cells = [[], [], []]
        for body in batch.column("html"):
            found = blocks(body.as_py() or "")
            cells[0].append([_hash("tag", path) if text is None else None if main else _hash("text", path, text) for path, text, main in found])
            cells[1].append([text for _, text, _ in found])
            cells[2].append([main for _, _, main in found])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host", "page")), *map(pa.array, cells, types)],
                                         [c.split()[0] for c in SEQUENCES.split(", ")])


def told_apart(roles: list[int | None], template: dict[int, tuple[int, int, int]]) -> list[int | None]:
    """Roles by the innermost gap of the template they stand in; the template's own roles stay."""
    out, opened = [], []
    for role in roles:
        if (at := template.get(role)) is None:
            out.append(_hash("role", f"{role} {opened[-1]}") if opened and role is not None else role)
            continue
        out.append(role)
        _, place, size = at
        if place:
            opened.pop()
        if place < size - 1:
            opened.append(at)
    return out


def _successors(host: str, _: int, roles: list[int | None], template: dict) -> set[tuple]:
    """(host, role, next role of its class, 0 at the end)."""
    out, last = set(), {}
    for role in roles:
        if (at := template.get(role)) is not None:
            if at[0] in last:
                out.add((host, last[at[0]], role))
            last[at[0]] = role
    return out | {(host, role, 0) for role in last.values()}


def _crossed(host: str, _: int, roles: list[int | None], template: dict) -> set[tuple]:
    """(host, class) of the smaller one of two classes that cross."""
    out, opened = set(), []
    for role in roles:
        if (at := template.get(role)) is None:
            continue
        name, place, size = at
        if place == 0:
            opened.append((name, size))
            continue
        i = opened.index((name, size))
        for other in opened[i + 1:]:
            out.add((host, min(other, (name, size), key=lambda c: (c[1], c[0]))[0]))
        if place == size - 1:
            del opened[i]
    return out


def _times(host: str, page: int, roles: list[int | None], _: dict) -> list[tuple]:
    return [(host, role, page, n) for role, n in Counter(r for r in roles if r is not None).items()]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A host's roles with their only successors (0: none) to runs of two and more; a run is named by its first role."""
    kind = pa.list_(pa.struct([("role", pa.int64()), ("class", pa.int64()), ("place", pa.int32()), ("size", pa.int32())]))
    for batch in batches:
        cells = []
        for pairs in batch.column("pairs"):
            following = {p["role"]: p["next"] for p in pairs.as_py()}
            out = []
            for first in following.keys() - set(following.values()):
                run = [first]
                while (role := following[run[-1]]) in following:
                    run.append(role)
                if len(run) > 1:
                    out += [{"role": role, "class": first, "place": i, "size": len(run)} for i, role in enumerate(run)]
            cells.append(out)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(cells, kind)], ["host", "template"])


class _Rounds:
    """Templates of hosts by rounds, as {role: (class, place, size)}; the last thousand hosts' are held."""

    def __init__(self) -> None:
        self.known: dict[str, list[dict]] = {}

    def of(self, host: str, cell: pa.Scalar) -> list[dict]:
        if host not in self.known:
            if len(self.known) >= 1_000:
                self.known.clear()
            self.known[host] = [{p["role"]: (p["class"], p["place"], p["size"]) for p in some} for some in cell.as_py() or []]
        return self.known[host]


def _each_page(work: Callable, types: tuple[pa.DataType, ...], names: list[str]) -> Callable:
    """Rows of ``work`` (host, page, roles, template of the last round) for each page; the rounds before tell its roles apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Rounds()
        for batch in batches:
            rows = []
            for host, page, roles, cell in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "tokens")), batch.column("rounds")):
                rounds = held.of(host, cell)
                for template in rounds[:-1]:
                    roles = told_apart(roles, template)
                rows += work(host, page, roles, rounds[-1] if rounds else {})
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return run


def _stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of a page's tokens are texts outside the template."""
    held = _Rounds()
    for batch in batches:
        cells = []
        for host, roles, cell, texts in zip(batch.column("host").to_pylist(), batch.column("tokens").to_pylist(), batch.column("rounds"), batch.column("texts")):
            rounds = held.of(host, cell)
            for template in rounds[:-1]:
                roles = told_apart(roles, template)
            last = rounds[-1] if rounds else {}
            cells.append([i for i, (role, text) in enumerate(zip(roles, texts)) if text.is_valid and role not in last])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "texts", "main")), pa.array(cells, pa.list_(pa.int32()))],
                                         ["page_id", "url", "texts", "main", "stay"])


def _beside(pages: DataFrame, rounds: DataFrame, how: str) -> DataFrame:
    """``pages`` with their host's rounds. A host may hold a third of all pages: its rows go to SALT tasks, its template to each of them."""
    spread = rounds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<bigint>")))
    return pages.withColumn("salt", F.pmod("page", F.lit(SALT))).join(spread, ["host", "salt"], how).drop("salt")


def _classes(pages: DataFrame) -> DataFrame:
    """(host, template): large and frequent equivalence classes of roles. ``pages``: host, page, tokens, rounds."""
    counted = _each_page(_times, (pa.string(), pa.int64(), pa.int64(), pa.int32()), ["host", "role", "page", "times"])
    roles = pages.mapInArrow(counted, "host string, role long, page long, times int")
    vector = F.sum(F.shiftright(F.xxhash64("page", "times"), 16)).alias("vector")
    each = roles.groupBy("host", "role").agg(F.count("*").alias("pages"), vector)
    each, _ = write_out(each.where(F.col("pages") >= MIN_PAGES), "page-roles")
    sizes = pages.groupBy("host").agg(F.count("*").alias("n"))
    classes = each.groupBy("host", "pages", "vector").agg(F.count("*").cast("int").alias("size"), F.min("role").alias("class"))
    large = classes.join(sizes, "host").where((F.col("size") >= 2) & (2 * F.col("pages") >= F.col("n"))).drop("n")
    found = each.join(large, ["host", "pages", "vector"])
    return found.groupBy("host").agg(F.collect_list(F.struct("role", "class", F.lit(0).alias("place"), "size")).cast(_PLACES).alias("template"))


def _valid(pages: DataFrame, before: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, rounds): the rounds before and the ordered and nested parts of ``classes``."""
    def with_last(templates: DataFrame) -> DataFrame:
        return before.join(templates, "host").select("host", F.concat("rounds", F.array("template")).alias("rounds"))

    ordered = _each_page(_successors, (pa.string(), pa.int64(), pa.int64()), ["host", "role", "next"])
    pairs = _beside(pages, with_last(classes), "inner").mapInArrow(ordered, "host string, role long, next long")
    pairs = pairs.groupBy("host", "role").agg(F.min("next").alias("next"), F.max("next").alias("other"))
    pairs = pairs.select("host", F.struct("role", F.when(F.col("next") == F.col("other"), F.col("next")).otherwise(0).alias("next")).alias("pair"))
    runs = pairs.groupBy("host").agg(F.collect_list("pair").alias("pairs")).mapInArrow(_runs, f"host string, template {_PLACES}")
    runs, _ = write_out(runs, "page-runs")
    crossing = _each_page(_crossed, (pa.string(), pa.int64()), ["host", "class"])
    crossed = _beside(pages, with_last(runs), "inner").mapInArrow(crossing, "host string, class long")
    crossed = crossed.groupBy("host").agg(F.collect_set("class").alias("crossed"))
    kept = F.filter("template", lambda p: ~F.array_contains(F.coalesce("crossed", F.array().cast("array<bigint>")), p["class"]))
    return with_last(runs.join(crossed, "host", "left").select("host", kept.alias("template")))


def templates(sequences: DataFrame) -> DataFrame:
    """(host, rounds) of the hosts that have a template: each round's roles with class, place and size; the last one is the template."""
    pages = sequences.select("host", "page", "tokens")
    none = F.array().cast(f"array<{_PLACES}>").alias("rounds")
    active, known = pages.select("host").distinct().select("host", none), None
    last = lambda rounds: F.coalesce(F.size(F.element_at(rounds, -1)), F.lit(0))
    while True:
        # The template of the last round has not told roles apart yet: an empty one behind it makes it do so.
        opened = active.select("host", F.when(F.size("rounds") > 0, F.concat("rounds", F.array(F.array().cast(_PLACES)))).otherwise(F.col("rounds")).alias("rounds"))
        classes, _ = write_out(_classes(_beside(pages, opened, "inner")), "page-classes")
        new = _valid(pages, active, classes).withColumn("size", last(F.col("rounds")))
        old = active.select("host", F.when(F.size("rounds") > 0, F.size(F.try_element_at("rounds", F.lit(-1)))).otherwise(0).alias("least"))
        grown = new.join(old, "host").where(F.col("size") > F.col("least")).select("host", "rounds")
        grown, _ = write_out(grown, "page-templates")
        if grown.isEmpty():
            return grown if known is None else known
        known = grown if known is None else write_out(known.join(grown, "host", "left_anti").union(grown), "page-templates")[0]
        active = grown


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url").alias("page"))
    sequences, _ = write_out(rows.mapInArrow(_sequences, SEQUENCES), "page-tokens")
    slots = _beside(sequences, templates(sequences), "left").mapInArrow(
        _stay, "page_id long, url string, texts array<string>, main array<boolean>, stay array<int>")
    kept = F.transform("stay", lambda i: F.struct(F.get("texts", i).alias("text"), F.get("main", i).alias("main")))
    inside = F.filter("kept", lambda b: b["main"])
    size = lambda some: F.aggregate(some, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))
    # A page without such a container, or with a teaser in it, keeps all its slots.
    rows = slots.select("page_id", "url", kept.alias("kept")).select("page_id", "url", "kept", inside.alias("inside"))
    chosen = F.when((TEASER + 1) * size("inside") >= size("kept"), F.col("inside")).otherwise(F.col("kept"))
    text = rows.select("page_id", "url", F.array_join(F.transform(chosen, lambda b: b["text"]), "\n").alias("text"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
