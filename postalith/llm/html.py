"""Main text of web pages by nearest-URL page differencing.

Pages of a host stand in order of their URL's path; each page is paired with the neighbours that share more of it.
The text lines, those of a marked article and those outside it apart, are aligned by a longest common subsequence, and
lines that a page shares with both its nearest neighbours are template, not text. A neighbour that shares every line, or
most of the article, is a copy and tells nothing. In an article only what all neighbours, three at least, share before
its first own line or after its last is template: lines that recur in some articles or among own lines belong to them. Menus here change their words from page
to page, so the markup is heard as well: menus, headers, footers, sidebars, notices, adverts, forms and comments that
the markup names go.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalith.llm.common import Scratch, global_rank

#: A quote opens a value only after an equals sign; elsewhere in a tag it is a letter like any other.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|))*+)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")

RAW = frozenset("script style template iframe textarea title".split())
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table tr td th thead tbody tfoot caption section article main nav aside header footer form "
    "fieldset blockquote pre figure figcaption address hr body html head details summary dialog menu button select option center".split()
)
#: Elements that hold others: only these are kept on the stack, so stray inline tags do no harm.
NESTING = frozenset("div section article main nav aside header footer form fieldset table ul ol dl menu dialog figure details head body button select blockquote".split())
DROPPED = frozenset("nav aside header footer form menu dialog head button select".split())
#: Whole class names or ids (not parts of them) that name what is not text.
NAMES = frozenset(
    "ad ads advert advertisement sponsored promo banner cookie-notice cookie-banner cookies notice sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "header footer masthead comment comments related newsletter".split()
)
#: Neighbours that must share a line of an article for it to be template.
AGREE = 3
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())


def blocks(page: str) -> list[tuple[str, bool, bool]]:
    """Every block of a page: its text, whether an article or main element holds it, whether the markup drops it."""
    found: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, in article, dropped
    part: list[str] = []
    article = dropped = False
    at, skip = 0, None

    def close() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(part))).strip()
        part.clear()
        if text:
            found.append((text, article, dropped))

    for m in _TOKEN.finditer(page):
        if skip is None and m.start() > at:
            part.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, ends = tag.lower(), bool(m[1])
        if skip is not None:
            if ends and tag == skip:
                skip = None
            continue
        if tag in RAW:
            if not ends and not m[3].rstrip().endswith("/"):
                skip = tag
            continue
        if tag == "br":
            part.append(" ")
            continue
        if tag in BLOCKS:
            close()
        if tag in NESTING:
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        article, dropped = stack[i][1:]
                        del stack[i:]
                        break
            else:
                stack.append((tag, article, dropped))
                drop = tag in DROPPED
                main = tag in ("article", "main")
                for a in _ATTRIBUTE.finditer(m[3]):
                    value = (a[2] or a[3] or a[4] or "").lower()
                    if a[1].lower() == "role":
                        drop |= value in ROLES
                        main |= value == "main"
                    else:
                        drop |= not NAMES.isdisjoint(value.split()) and tag not in ("body", "main")
                dropped |= drop
                article |= main and not dropped
    if skip is None and at < len(page):
        part.append(page[at:])
    close()
    return found


def _key(text: str, seen: dict[int, int]) -> int:
    """A line's key: its hash and how often it stood before on the page, so that no key comes twice."""
    h = xxhash.xxh64_intdigest(text)
    n = seen[h] = seen.get(h, 0) + 1
    return xxhash.xxh64_intdigest(f"{h}:{n}") - 2**63


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in a of a longest common subsequence of two lists without repeats: a longest rising run of places in b."""
    where = {x: i for i, x in enumerate(b)}
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = [-1] * len(a)
    for i, x in enumerate(a):
        j = where.get(x)
        if j is None:
            continue
        k = bisect.bisect_left(tails, j)
        before[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(j), ends.append(i)
        else:
            tails[k], ends[k] = j, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def split_url(url: str | None) -> tuple[str, list[str]]:
    """Host in lower case, and the path's segments with the query as the last; the fragment is dropped."""
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", (url or "").strip()).split("#", 1)[0]
    if rest.startswith("//"):
        host, _, rest = rest[2:].partition("/")
    else:
        host = ""
    path, _, query = rest.partition("?")
    return host.lower(), [x for x in path.split("/") if x] + ([f"?{query}"] if query else [])


def extract(pages: DataFrame, scratch: Scratch, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Main text of every page: (key, url, text, n_chars), blocks in page order joined by a line end.

    Null html gives the empty text. A null or broken url counts as a path on the host "". A page whose html has an
    article or main element gives that element's blocks, others give all; of these go the blocks that the markup drops
    and those that the neighbours share, in an article only where all of three or more share all up to its start or its end.
    Neighbours are the three pages before and after on the same host, those with more of the
    path first; copies, which share every line or have those of a nearer neighbour, do not count, and of the others
    the first two must agree, or the only one decides. Repeated rows are one page and give the same text each. Very long pages are pages like any other. An
    empty table gives an empty one; other columns, whatever their names, play no part.
    """
    kind = pages.schema[key].dataType.simpleString()
    base = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("mark", F.xxhash64("html"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, keys, articles, sizes = [], [], [], [], []
            for u, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                host, path = split_url(u)
                seen: dict[int, int] = {}
                found = blocks(h)
                hosts.append(host), paths.append(path)
                keys.append([_key(t, seen) for t, article, _ in found if not article])
                seen = {}
                inner = [t for t, article, dropped in found if article and not dropped]
                articles.append([_key(t, seen) for t in inner]), sizes.append([len(t) for t in inner])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(hosts, pa.string()), pa.array(paths, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64())), pa.array(articles, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))],
                names=["key", "url", "mark", "host", "path", "lines", "article", "sizes"],
            )

    light = base.mapInArrow(lines, f"key {kind}, url string, mark long, host string, path array<string>, lines array<long>, article array<long>, sizes array<long>").dropDuplicates(["key", "url", "mark"])
    light = scratch.keep(light, "lines")
    ranked = scratch.keep(global_rank(light, ["host", "path", "key", "url", "mark"], scratch, "order"), "ranked")
    by = F.explode(F.array(*map(F.lit, (-1, 1, -2, 2, -3, 3)))).alias("by")
    sent = ranked.select("rank", by, F.struct("host", "path", "lines", "article").alias("page")).select((F.col("rank") + F.col("by")).alias("rank"), F.struct((-F.col("by")).alias("by"), "page").alias("side"))
    sides = ranked.join(sent.groupBy("rank").agg(F.collect_list("side").alias("sides")), "rank", "left")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3, 9)))
            out = [edges(host, path, article, sizes, near or []) if article else template(host, path, own, near or []) for host, path, own, article, sizes, near in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int32()))], names=["_key", "_url", "_mark", "shared"])

    marks = sides.select("key", "url", "mark", "host", "path", "lines", "article", "sizes", "sides").mapInArrow(shared, f"_key {kind}, _url string, _mark long, shared array<int>")
    marks = scratch.keep(marks.where(F.size("shared") > 0), "shared")
    scratch.drop("lines", "order", "ranked")

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(blocks(h), s) for h, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[key, url, "text", "n_chars"])

    same = F.col("key").eqNullSafe(F.col("_key")) & F.col("url").eqNullSafe(F.col("_url")) & (F.col("mark") == F.col("_mark"))
    return base.join(marks, same, "left").select("key", "url", "html", "shared").mapInArrow(text, f"`{key}` {kind}, `{url}` string, text string, n_chars long")


def nearest(host: str, path: list[str], sides: list[dict]) -> list[dict]:
    """The neighbours (by: how far off, page: host, path, lines, article) on a page's host, those with more of its path first."""

    def off(side: dict) -> tuple[int, int, int]:
        same = next((i for i, (x, y) in enumerate(zip(path, side["page"]["path"])) if x != y), min(len(path), len(side["page"]["path"])))
        return -same, abs(side["by"]), side["by"]

    return sorted((x for x in sides if x["page"]["host"] == host), key=off)


def template(host: str, path: list[str], own: list[int], sides: list[dict]) -> list[int]:
    """Places of a page's lines that belong to its template, given its neighbours."""
    found: list[list[int]] = []
    seen: list[list[int]] = []
    for side in nearest(host, path, sides):
        lines = side["page"]["lines"]
        places = common(own, lines)
        if len(places) < len(own) and lines not in seen:
            found.append(places)
            seen.append(lines)
        if len(found) == 2:
            break
    return sorted(set(found[0]).intersection(*found[1:])) if found else []


def edges(host: str, path: list[str], own: list[int], sizes: list[int], sides: list[dict]) -> list[int]:
    """Places of an article's lines (and their sizes) that stand before its first own line or after its last.

    Own is what one of the neighbours does not share. Those without an article, those that share more than half of
    this one's characters and copies of a nearer one do not count; with fewer than AGREE left, all lines are own.
    """
    found: list[list[int]] = []
    seen: list[list[int]] = []
    for side in nearest(host, path, sides):
        lines = side["page"]["article"]
        places = common(own, lines)
        if lines and lines not in seen and 2 * sum(sizes[i] for i in places) <= sum(sizes):
            found.append(places)
            seen.append(lines)
    if len(found) < AGREE:
        return []
    every = set(found[0]).intersection(*found[1:])
    mine = [i for i in range(len(own)) if i not in every]
    return [i for i in range(len(own)) if i < mine[0] or i > mine[-1]]


def main_text(found: list[tuple[str, bool, bool]], shared: list[int] | None) -> str:
    """The text of a page's blocks, given the places of those that its neighbours share: among an article's blocks, or all."""
    gone = set(shared or ())
    inner = [t for t, article, dropped in found if article and not dropped]
    if inner or any(article for _, article, _ in found):
        return "\n".join(t for i, t in enumerate(inner) if i not in gone)
    return "\n".join(t for i, (t, _, dropped) in enumerate(found) if not dropped and i not in gone)
