"""Main text of web pages by a site style tree."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import arrow_map, pinned, table, unused

#: A style node whose importance lies below this (half of it inside an article) goes.
LOW = 0.25
#: Entropies of a node on fewer pages are measured as if it were on so many: what few pages share tells little.
PRIOR_PAGES = 8
#: A node that the rules mark as noise stays if its content is as important and it holds this share of its host's text.
HIGH = 0.75
MASS = 0.25
#: As many turned nodes, some 100 bytes each, may be broadcast; more are joined by host in a shuffle.
NODES_SENT = 200_000
ROWS = 128
#: Elements on a style path.
DEEP = 256

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")
#: Elements that are no text on the page, or mark theirs as noise (``WEAK``).
NOISE = frozenset(
    "head script style noscript template iframe svg math canvas object nav footer aside form button select textarea input dialog menu title xmp noembed noframes audio video map datalist label option".split()
)
WEAK = frozenset("nav footer aside form button dialog menu label".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening block closes: a paragraph by any block, and these by their like.
LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
FENCE = frozenset("table ul ol dl article section div body html aside nav footer main blockquote td th".split())
MARKS = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|subscription|signup|paywall"
    r"|comments?|commentlist|disqus|replies|respond|sidebar|side|widget\w*|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|footer|header|masthead|topbar"
    r"|share|sharing|social|related|recommended|toolbar|skip|hidden|copyright|legal|disclaimer|login|search)(?:$|[-_\s\d])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar alertdialog".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
CUT = re.compile(r"[\s ]+")
DIGITS = re.compile(r"\d+")


def _noise(tag: str, attributes: str, in_article: bool) -> tuple[int, str]:
    """2 if an element is not shown as text, 1 if its name, role or class marks it as noise, else 0; its class for the path."""
    marked = 2 if tag in NOISE and tag not in WEAK else int(tag in WEAK or tag == "header" and not in_article)
    if not attributes.strip():
        return marked, ""
    found = {k.lower(): (v or "").strip("\"'") for k, v in NAMED.findall(attributes)}
    label = f"{found.get('class', '')} {found.get('id', '')}".strip()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        marked = 2
    elif found.get("role", "").lower() in ROLES or bool(label) and tag not in ("html", "body", "main", "h1") and bool(MARKS.search(label)):
        marked = max(marked, 1)
    return marked, DIGITS.sub("0", found.get("class", "").strip().lower())


def blocks(page: str | None) -> list[tuple[str, bool, bool, str]]:
    """Text blocks shown on a page in page order: style path, marked by rule, inside an article, text.

    The path starts with what the rules say (``-`` marked, ``+`` in an article), so that a node of the style tree has one
    mark; then come the open elements' names with their classes, formatting elements left out. Unclosed and misplaced tags, cut
    pages and comments are read as a browser would; character references are decoded, white space becomes one space.
    """
    out: list[tuple[str, bool, bool, str]] = []
    if not page:
        return out
    stack: list[tuple[str, int, str, bool]] = []  # name, noise so far, path so far, in an article
    held: list[str] = []

    def flush() -> None:
        if held:
            text = CUT.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            if text:
                _, noise, path, inside = stack[-1] if stack else ("", 0, "", False)
                if noise < 2:
                    out.append((("-" if noise else "+" if inside else "") + path, bool(noise), inside, text))

    def close(name: str, fence: frozenset[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                flush_if_block(stack[k:])
                del stack[k:]
                return
            if stack[k][0] in fence:
                return

    def flush_if_block(gone: list) -> None:
        if any(x[0] in BLOCK or x[0] in NOISE for x in gone):
            flush()

    at, lower = 0, ""
    match = TOKEN.search
    while True:
        m = match(page, at)
        if m is None:
            if at < len(page):
                rest = page[at:]
                cut = re.search(r"<[/a-zA-Z][^>]*\Z", rest)  # a tag that the end of the page cuts
                held.append(rest[: cut.start()] if cut else rest)
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name, closing, attributes = name.lower(), (m[1] if m[2] else m[4]) == "/", (m[3] if m[2] else m[6]) or ""
        if closing:
            if name == "p" and not any(x[0] == "p" for x in stack):
                flush()
            elif name == "br":
                held.append(" ")
            else:
                close(name, frozenset())
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                held.append(" ")
            continue
        if name in BLOCK or name in NOISE:
            flush()
            if name in BLOCK:
                close("p", FENCE)
            for like in LIKE.get(name, ()):
                close(like, FENCE - {like})
        _, noise, path, inside = stack[-1] if stack else ("", 0, "", False)
        bad, label = _noise(name, attributes, inside)
        if name in BLOCK or bad:
            path = f"{path}/{name}.{label}" if label else f"{path}/{name}"
        if attributes.endswith("/") and name not in BLOCK:
            continue
        inside = inside or name in ("article", "main")
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if name not in NOISE:
                held.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        # nested deeper, elements share the path of the one at that depth; they open and close like any other
        stack.append((name, max(noise, bad), path if len(stack) < DEEP else stack[-1][2], inside))
    flush()
    return out


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame, low: float = LOW, prior_pages: int = PRIOR_PAGES) -> DataFrame:
    """The nodes of each host's style tree whose importance overrules the rules: host, path.

    All text blocks of the pages of a host are merged by style path. For a node on m of the host's pages, a content feature
    (the digest of a block's text) on c of them has the entropy log c / log m: 0 if it is on one page only, 1 if on all. The
    importance of the content is 1 less the mean entropy over the node's features; that of the presentation is the entropy of
    how often the node occurs on a page, log-scaled in the same way. Where m is below ``prior_pages`` that number takes its
    place in the logarithm that the entropies are measured by: as a node's pages become few, what speaks against it fades, and
    so does what speaks against its mark; a small host has a tree like any other. A node goes if the larger of the two is
    below ``low``, inside an article below half of it. A node that the rules mark goes too, unless log m less the mean of log c,
    so measured, reaches ``HIGH`` and it holds the share ``MASS`` of its host's text.
    Counts are aggregated before they are shuffled, by host, path and digest, so that a hot host is spread.
    """

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                rows: dict[tuple[str, str, int], int] = {}
                chars: dict[tuple[str, str], int] = {}
                for site, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    seen: dict[str, set[int]] = {}
                    for path, _, _, text in blocks(page):
                        seen.setdefault(path, set()).add(hash_of(text))
                        chars[site, path] = chars.get((site, path), 0) + len(text)
                    for path, texts in seen.items():
                        for x in (*texts, 0, -len(texts)):  # 0 counts the pages, -n those with n features
                            key = (site, path, x)
                            rows[key] = rows.get(key, 0) + 1
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array([k[n] for k in rows], kind) for n, kind in enumerate((pa.string(), pa.string(), pa.int64()))),
                            pa.array(list(rows.values()), pa.int64()),
                            pa.array([0 if k[2] else chars[k[0], k[1]] for k in rows], pa.int64()),
                        ],
                        ["host", "path", "feature", "pages", "chars"],
                    )

    counted = arrow_map(pages.select("host", "html"), features, "host string, path string, feature bigint, pages bigint, chars bigint")
    counted = counted.groupBy("host", "path", "feature").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))
    logs = F.log(F.col("pages").cast("double"))
    kind = F.when(F.col("feature") > 0, "content").when(F.col("feature") < 0, "style")
    summed = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("feature") == 0, F.col("pages"))).alias("m"),
        F.avg(F.when(kind == "content", logs)).alias("content"),
        F.sum(F.when(kind == "style", F.col("pages") * logs)).alias("style"),
        F.sum("chars").alias("chars"),
    )
    whole = summed.groupBy(F.col("host").alias("site")).agg(F.sum("chars").alias("whole"))
    summed = summed.join(whole, F.col("host") == F.col("site"))
    pages_of = F.log(F.greatest(F.col("m"), F.lit(prior_pages)).cast("double"))
    own = F.log(F.col("m").cast("double"))
    content = 1 - F.col("content") / pages_of
    style = (own - F.col("style") / F.col("m")) / pages_of
    least = F.when(F.col("path").startswith("+"), low / 2).otherwise(low)
    stays = ((own - F.col("content")) / pages_of >= HIGH) & (F.col("chars") >= MASS * F.col("whole"))
    return summed.where(F.when(F.col("path").startswith("-"), stays).otherwise(F.greatest(content, style) < least)).select("host", "path")


def hash_of(text: str) -> int:
    """A positive digest of a block's text."""
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 2 | 1


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but html, if none are named) and text, the main text of each whole page.

    Two passes over the pages: one builds the style trees of the hosts, one removes from each page the branches that the tree of
    its host finds of low importance, or that are marked by element, role or class and not found important. The nodes where tree
    and rules differ are broadcast if there are few of them, else joined by host.

    Null or empty html: ''. Null url: the pages without a host share a tree. Repeated pages: each is a page of its host, so what
    a page shares with its own copies counts as shared by pages; if that leaves a page nothing, what is unmarked in an article
    stays. Very long pages are read whole. Other columns pass through; one named text is replaced. Empty table: no rows.
    """
    names = [c for c in (keep or pages.columns) if c not in (html, "text")]
    own_host, own_html, other, turned_ = (unused(names, n) for n in ("host_", "html_", "host__", "turned_"))
    source = pages.select(*names, F.col(html).alias(own_html), host(F.col(url)).alias(own_host))
    nodes = pinned(style_tree(pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html"))))
    per_host = nodes.groupBy(F.col("host").alias(other)).agg(F.sort_array(F.collect_list("path")).alias(turned_))
    if nodes.count() <= NODES_SENT:
        per_host = F.broadcast(per_host)
    joined = source.join(per_host, F.col(own_host) == F.col(other), "left").select(*names, own_html, turned_)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [main_text(page, frozenset(turned or ())) for page, turned in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, "text"])

    return arrow_map(joined, run, StructType([*source.select(*names).schema.fields, StructField("text", StringType())]))


def main_text(page: str | None, turned: frozenset[str] = frozenset()) -> str:
    """The blocks that the rules do not mark, but for ``turned`` nodes, whose blocks are treated the other way.

    If that leaves nothing, as on a host that serves one page under many addresses, what is unmarked in an article stays.
    """
    found = blocks(page)
    kept = [b for b in found if b[1] == (b[0] in turned)] or [b for b in found if b[2] and not b[1]]
    return "\n".join(b[3] for b in kept)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``extract`` of all pages, which tells what odd rows give."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
