"""Main text of web pages, by differencing each page with its nearest neighbours in URL order.

The order is host, path, id, content. Each page is compared with the nearest page before and after it in its host whose
content differs: their text lines are aligned by a longest common subsequence, and shared lines are deleted. A first pass
over narrow keys finds the ranges that the order is cut into, so that a hot host is split among tasks, and the few pages
next to each cut; those are also sent to the range across it, so the result doesn't depend on where the cuts are. Two things
come before differencing, as sharing alone can't tell them: elements that are menus, footers, adverts and the like by tag,
role, class or id are left out; and if a page marks its article, the lines outside it are left out, and those inside stay
even if a neighbour (a copy of the page, say) has them too. A page without a marked article whose lines are all shared keeps
them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow
from tracelake.llm.urlfilter import host_and_path

# HTML's element kinds, and which open elements a start tag ends where their end tags are left out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "head", "title", "option", "button", "select", "textarea"}
IN_HEAD = frozenset("base link meta noscript script style template title".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}}
SCOPES = frozenset("ul ol menu dl table select body".split())
SKIPPED = frozenset("aside button dialog footer form head iframe input label menu nav noscript object script select style svg template textarea title".split())
#: Skipped elements in which a marked article counts nevertheless: some sites wrap a whole page in a form.
OPENED = frozenset(["form"])
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
HINTS = frozenset("ad ads advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promos promoted banner banners nav navbar navigation menu menus breadcrumb breadcrumbs masthead footer footers sidebar sidebars widget widgets related recommended share sharing social cookie cookies consent gdpr notice notices notification notifications alert alerts newsletter newsletters subscribe popup popups modal modals comment comments disqus reply replies login signup search".split())
#: Names of two parts that tell, where a part alone doesn't.
PAIRS = frozenset("site-header page-header side-bar side-bars".split())
#: A name that begins or ends so tells what a page has or lacks, not what the element is.
ABOUT = frozenset("no not has have with without hide hidden is are can show layout open closed enabled disabled on off count".split())


COMMENTS = frozenset("comment comments reply replies disqus".split())


def hint(names: str) -> int:
    """How surely a class or id names something besides the article: 3 as a whole (or reader comments), 2 by its first part, 1 by a later part."""
    found = 0
    for name in names.lower().split():
        parts = re.split("[-_]+", name)
        if name in HINTS or name in PAIRS:
            found = 3
        elif parts[0] not in ABOUT and parts[-1] not in ABOUT:
            pairs = [f"{a}-{b}" in PAIRS for a, b in zip(parts, parts[1:])]
            if not COMMENTS.isdisjoint(parts):
                found = 3
            elif parts[0] in HINTS or pairs[:1] == [True]:
                found = max(found, 2)
            elif not HINTS.isdisjoint(parts) or any(pairs):
                found = max(found, 1)
    return found


class Lines(HTMLParser):
    """The page's blocks of text: (text, whether inside a marked article), without skipped elements.

    A marked article (article, main, or the role main) counts unless its own whole name says otherwise, as that of a reader
    comment does, or an element around it is skipped surely: by its tag, its role, or the beginning of its name. A later
    part of a name, as in content-sidebar-wrap, leaves out what is around a marked article only.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, bool]] = []
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, skipped by tag or role, skipped at all, in an article
        self.parts: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.lines.append((text, bool(self.open) and self.open[-1][3]))

    def end(self, tags: frozenset[str] | set[str], scopes: frozenset[str]) -> None:
        """Close the innermost open one of `tags`, if no scope is between."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                del self.open[i:]
                return
            if self.open[i][0] in scopes:
                return

    def leave_head(self) -> None:
        if any(x[0] == "head" for x in self.open) and self.open[-1][0] == "head":
            self.open.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag not in IN_HEAD:
            self.leave_head()
        if tag in CLOSES_P:
            self.end({"p"}, BLOCKS - {"p"})
        for ended in sorted(ENDS.get(tag, ())):
            self.end({ended}, SCOPES)
        if tag in VOID:
            return
        hard, skipped, inside = self.open[-1][1:] if self.open else (False, False, False)
        about = dict(attrs)
        named, role = f"{about.get('class') or ''} {about.get('id') or ''}", (about.get("role") or "").lower()
        marked = tag in ("article", "main") or role == "main"
        own, name = tag in SKIPPED or (tag == "header" and not inside) or role in ROLES, 0 if tag in ("html", "body") else hint(named)
        if marked and not hard and not own:
            skipped = name == 3
            hard, inside = skipped, not skipped
        else:
            hard = hard or (own and tag not in OPENED) or name > 1
            skipped = skipped or own or hard or name > 0
            inside = inside and not skipped
        self.open.append((tag, hard, skipped, inside))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.end({tag}, frozenset())

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.leave_head()
        if not (self.open and self.open[-1][2]):
            self.parts.append(data)


def lines_of(html: str | None) -> list[tuple[str, bool]]:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.lines


def common(a: list[str], b: list[str]) -> set[int]:
    """Indices of a in a longest common subsequence of a and b: the longest increasing run of matching places."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[str, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[k], chains[k] = j, link
    found = set(range(head)) | set(range(len(a) - tail, len(a)))
    link = chains[-1] if chains else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def main_text(lines: list[tuple[str, bool]], neighbours: list[list[tuple[str, bool]]]) -> str:
    inside = [text for text, marked in lines if marked]
    if inside:
        return " ".join(inside)
    own = [text for text, _ in lines]
    shared: set[int] = set()
    for other in neighbours:
        shared |= common(own, [text for text, _ in other])
    left = [text for i, text in enumerate(own) if i not in shared]
    return " ".join(left or own)


KEY = ["host", "path", "page_id", "content"]


def _key(host: str, path: str, page_id: int | None, content: int) -> tuple:
    """Orders as Spark does: strings by their bytes, nulls first."""
    return host.encode("utf-8", "surrogatepass"), path.encode("utf-8", "surrogatepass"), page_id is not None, page_id or 0, content


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted keys: the first, the first and the last that differ in content from the partition's ends, and the last."""
    first = after = before = last = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in KEY)):
            first = first or row
            if not after and row[3] != first[3]:
                after = row
            if last and row[3] != last[3]:
                before = last
            last = row
    found = [row for row in (first, after, before, last) if row]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*found), (pa.string(), pa.string(), pa.int64(), pa.int64()))], KEY)


def _ranges(keys: DataFrame, parts: int) -> tuple[list[tuple], list[list[tuple]]]:
    """The first key of each range, in order, and of each range the keys across its cuts: at most two before and two after.

    Of every partition at most four narrow keys come to the driver.
    """
    rows = keys.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY)
    edges = map_arrow(rows.select(*KEY, F.spark_partition_id().alias("part")), _edges_by_part, "host string, path string, page_id long, content long, part int").collect()
    by_part: dict[int, list[tuple]] = {}
    for r in edges:
        by_part.setdefault(r.part, []).append(_key(r.host, r.path, r.page_id, r.content))
    ranges = sorted(sorted(set(x)) for x in by_part.values())
    across: list[list[tuple]] = []
    for i, own in enumerate(ranges):
        found = []
        for rest in ((x for r in reversed(ranges[:i]) for x in reversed(r)), (x for r in ranges[i + 1 :] for x in r)):
            near: list[tuple] = []
            for x in rest:
                if not near or x[-1] != near[0][-1]:
                    near.append(x)
                if len(near) == 2:
                    break
            found += near
        across.append(found)
    return [r[0] for r in ranges], across


def _edges_by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = None

    def noted() -> Iterator[pa.RecordBatch]:
        nonlocal part
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0]
            yield batch

    for found in _edges(noted()):
        yield found.append_column("part", pa.array([part.as_py()] * found.num_rows, pa.int32()))


def _dealt(shared):
    """Each page's lines, to its range and, as a neighbour only, to the ranges whose edge it is next to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, across = shared.value
        beyond: dict[tuple, list[int]] = {}
        for i, keys in enumerate(across):
            for key in keys:
                beyond.setdefault(key, []).append(i)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                row, part, own, lines, inside = [], [], [], [], []
                for i, (*names, html) in enumerate(zip(*(piece.column(c).to_pylist() for c in KEY), piece.column("html"))):
                    key = _key(*names)
                    home, found = bisect_right(firsts, key) - 1, lines_of(html.as_py())
                    for to in (home, *beyond.get(key, ())):
                        row.append(i)
                        part.append(to)
                        own.append(to == home)
                        lines.append([text for text, _ in found])
                        inside.append([x for _, x in found])
                rest = [piece.column(c).take(pa.array(row, pa.int64())) for c in (*KEY, "url")]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *rest, pa.array(own, pa.bool_()), pa.array(lines, pa.list_(pa.string())), pa.array(inside, pa.list_(pa.bool_()))], ["part", *KEY, "url", "own", "lines", "inside"])

    return run


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and order: each own page with the nearest before and after it that differ, of the same host.

    A run of pages of one content waits for the page after it; of these only ids and urls are held, and the lines once.
    """
    out: list[tuple] = []

    def batch_of(rows):
        ids, urls, texts = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    def settle(before, run, after):
        place, lines, waiting = run
        near = [x[1] for x in (before, after) if x and x[0][:2] == place[:2]]
        text = main_text(lines, near)
        out.extend((i, url, text) for i, url in waiting)

    before = run = None
    for batch in batches:
        for part, host, path, i, content, url, own, lines, inside in zip(*(batch.column(c) for c in ("part", *KEY, "url", "own", "lines", "inside"))):
            place = (part.as_py(), host.as_py(), content.as_py())
            if not run or run[0] != place:
                fresh = (place, list(zip(lines.as_py(), inside.as_py())), [])
                if run:
                    settle(before, run, fresh)
                before, run = run, fresh
            if own.as_py():
                run[2].append((i.as_py(), url.as_py()))
            if len(out) >= 500:
                yield batch_of(out)
                out.clear()
    if run:
        settle(before, run, None)
    if out:
        yield batch_of(out)


def extracted(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html); other columns are not read.

    text: the kept blocks in page order, white space within them as one space, joined by one space; empty for null or empty
    html. Rows of a null url, or one without a host, have the empty host and are neighbours of each other; repeated rows
    come out as they come in. The result doesn't depend on the number of partitions.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"), path.alias("path"), F.xxhash64("html").alias("content"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(_ranges(rows.select(*KEY), n))
    schema = "part int, host string, path string, page_id long, content long, url string, own boolean, lines array<string>, inside array<boolean>"
    dealt = map_arrow(rows.select(*KEY, "url", "html"), _dealt(shared), schema)
    near = dealt.repartition(n, "part").sortWithinPartitions("part", *KEY)
    return map_arrow(near, _extracted, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
