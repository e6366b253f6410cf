"""Main text of web pages: the host's suffix array over every page's tokens, then an exact check by markup.

A page's token stream is all its text, menus and footers with it; only scripts, styles and the like are no text. The host's streams are
concatenated, with the page as a separator, and their suffixes are put in order; the common prefix of neighbours on distinct pages, if
it is at least ``run`` tokens long, is a repeated substring, and its tokens are boilerplate. What stays are the unique runs, block by
block. Every token of a common prefix of ``run`` tokens or more lies in one of exactly ``run`` tokens, and conversely; so the tokens
covered are known once suffixes are ordered by their first ``run`` tokens, and no suffix is compared further.

The check. Repetition alone can't give right results on pages like ours: menus, adverts and footers may be unique to their page, and
articles may be copied in full (figures are in the README). So where markup names the main element, its blocks are put back whole and
all others go. The main element is a ``main`` (or role=main) that holds text, else an ``article`` outside marked elements, else any
``article``. Elements that are no article text go on any page: by tag (menus, headers of the page, footers, sidebars, forms), and, of
elements that can hold blocks, by a whole word of class, id or role (adverts, notices, comments and the like). Elements around the main
one are never judged, and neither are its paragraphs. Where markup names no main element, the array decides.

The array is sorted in pieces. Distinct streams are dealt out by their hash, so equal pages meet in one part and count as one. A part
sorts its suffixes and sends each key once, marked where two of its pages have it; the keys are dealt out by range, so a large host is
spread over all tasks and no list of its pages is built. First 40 bits of each key go and one bit comes back, whether it may be
repeated; then those that may go with all 96 bits, which decide.

Blocks: text between block tags, character references decoded, white space turned into one space; ``br`` is white space.
Edge cases: null html is empty and gives an empty text; a null url has an empty host; rows with equal ids and html are one page with
equal results; unclosed elements end with the element around them; a self-closed element holds nothing; a script, style, title or
textarea without an end runs to the page's end; other columns are neither read nor kept.
"""

from __future__ import annotations

import html as _html
import marshal
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import _ODD, gram_hashes, mix, partitions, slices
from .near_dedup import _runs
from .url_filters import split_url

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_ROLE = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
#: Elements whose content is no markup; the first four run to the end of the page if they are not closed.
_OPEN = ("script", "style", "title", "textarea")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in (*_OPEN, "template", "noscript", "svg", "iframe", "object")}
#: Elements that end a text block, that hold no article text, and that have no content.
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
NOT_TEXT = set("aside button dialog footer form head header label menu nav select".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id or role that mark what is no article text.
MARKS = set(
    """ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies dialog disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification pagination popup promo promoted related respond search share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget
    ad-banner ad-container ad-slot comment-form comment-list comment-section comments-area cookie-banner cookie-notice main-menu main-nav page-footer page-header post-comments related-posts share-buttons site-footer site-header site-nav social-share widget-area""".split()
)
#: Elements whose class, id and role are read: those that can hold blocks. A marked paragraph or span is text like any other.
_JUDGED = set("center details div dl figure ol section table ul".split())
_TRACKED = (BLOCK | NOT_TEXT) - VOID - {"p", "li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "option"}
#: Where a block stands: outside of everything that is left out, and in which kind of main element.
ANYWHERE, MARKED_ARTICLE, ARTICLE, MAIN = 0, 1, 2, 3
#: What the check says of a block.
GONE, KEPT, OPEN = 0, 1, 2
#: Bytes of html a part of the streams.
PART = 16 << 20
#: Text that a task parses before it deals it out, in bytes.
_HELD = 16 << 20
#: Characters of streams that are hashed at once.
_HASHED = 1 << 20
#: The lowest 0 to 8 bytes of a number.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def judged(page: str | None) -> list[tuple[int, str]]:
    """All text blocks in page order, each with what the check says of it: GONE, KEPT, or OPEN where the array decides."""
    found: list[tuple[int, str]] = []
    buf: list[str] = []
    aside: list[str] = []  # text that is left out
    kind = ANYWHERE  # of buf's text
    stack: list[tuple[str, int]] = [("", ANYWHERE)]  # tag, and what its text is; -1: left out, -2: left out for a mark

    def flush() -> None:
        for parts, what in ((buf, kind), (aside, -1)):
            if text := " ".join("".join(parts).split()):
                found.append((what, text))
            parts.clear()

    page = page or ""
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            part = page[at:stop]
            if stack[-1][1] >= 0:
                kind = stack[-1][1]
            (buf if stack[-1][1] >= 0 else aside).append(_html.unescape(part) if "&" in part else part)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, attrs = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "br":
            (buf if stack[-1][1] >= 0 else aside).append(" ")
            continue
        if tag in BLOCK:
            flush()
        if closing:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in VOID or attrs.endswith("/") and not attrs.endswith(("=/", '"/"')):
            continue
        if tag in _RAW:
            if close := _RAW[tag].search(page, at):
                at = close.end()
            elif tag in _OPEN:
                at = end
            continue
        if tag not in _TRACKED:
            continue
        words = {w for _, v in _ATTR.findall(attrs) for w in v.strip("\"'").lower().split()} if "=" in attrs else set()
        now = stack[-1][1]
        if tag == "main" or _ROLE.search(attrs):
            now = MAIN
        elif tag == "article" and now != -1 and now < MARKED_ARTICLE:
            now = ARTICLE if now == ANYWHERE and MARKS.isdisjoint(words) else MARKED_ARTICLE
        elif now >= 0:
            if tag in NOT_TEXT and not (tag == "header" and now > ANYWHERE):
                now = -1
            elif (tag in _JUDGED or tag == "article") and not MARKS.isdisjoint(words):
                now = -2
        stack.append((tag, now))
    flush()
    main = max((k for k, _ in found), default=ANYWHERE)
    return [(GONE if k < 0 or k < main else KEPT if main > ANYWHERE else OPEN, t) for k, t in found]


def blocks(page: str | None) -> tuple[list[str], bool]:
    """The text blocks that the check leaves, in page order, and whether they are final: those of a named main element, or none."""
    found = [(v, t) for v, t in judged(page) if v != GONE]
    return [t for _, t in found], all(v == KEPT for v, _ in found)


def _ordered(keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order; the entries in that order, those of one key as they come; where in it each key begins, and how many it has.
    A single key has 40 bits, so that it and its entry's place are sorted as one number."""
    n = len(keys[0])
    if len(keys) == 1 and n <= 1 << 24:
        s = np.sort(keys[0] << np.uint64(24) | np.arange(n, dtype=np.uint64))
        o, keys = (s & _LOWEST[3]).astype(np.int64), [s >> np.uint64(24)]
    else:
        o = np.lexsort(keys[::-1])
        keys = [k[o] for k in keys]
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    heads = np.flatnonzero(new)
    return [k[heads] for k in keys], o, heads, np.diff(heads, append=n)


def _word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of a text whose words are joined by one space: 8 bytes at a time, of words over 32 bytes by xxh3."""
    if not text:
        return np.empty(0, np.uint64)
    text += b" "
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    starts = np.r_[0, ends[:-1] + 1]
    size = ends - starts
    eight = np.ndarray(len(text), "<u8", text + bytes(8), strides=(1,))
    h = mix((eight[starts] & _LOWEST[np.minimum(size, 8)]) ^ size.astype(np.uint64) * _ODD[0])
    for k in (8, 16, 24):
        i = np.flatnonzero(size > k)
        h[i] = mix(h[i] * _ODD[1] ^ (eight[starts[i] + k] & _LOWEST[np.minimum(size[i] - k, 8)]))
    for i in np.flatnonzero(size > 32).tolist():
        h[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]])
    return h


def _squeezed(b: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=6).compress(b, asbytes=True)


def _planes(k: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of numbers, byte plane by byte plane, which compress well."""
    return np.ascontiguousarray(k.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T).tobytes()


def _numbers(blob: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(blob, np.uint8).reshape(width, n).T
    return out.view(">u8").ravel().astype(np.uint64)


def _sent(part: int, keys: list[np.ndarray], widths: tuple[int, ...], several: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """A part's distinct keys by bucket; buckets are ranges of the first key, which goes as differences."""
    high = keys[0] >> np.uint64(8 * widths[0] - 32)
    cuts = np.searchsorted((high * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), np.arange(buckets + 1))
    rows = [(b, part, hi - lo, _squeezed(b"".join(_planes(k, w) for k, w in zip((np.diff(keys[0][lo:hi], prepend=np.uint64(0)), *(k[lo:hi] for k in keys[1:])), widths, strict=True)) + np.packbits(several[lo:hi]).tobytes())) for b, (lo, hi) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)) if hi > lo]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["bucket", "part", "n", "keys"])


def _repeated(sent: DataFrame, widths: tuple[int, ...], name: str) -> DataFrame:
    """part, and one bit a key sent, whether two pages have it: binaries with the bucket and the number of keys first."""

    def run(batches):
        for bucket, parts, sizes, blobs in _runs(batches, 1):
            sizes, got, marks = sizes.to_pylist(), [[] for _ in widths], []
            for n, b in zip(sizes, blobs.to_pylist(), strict=True):
                at, b = 0, pa.decompress(b, sum(widths) * n + (n + 7) // 8, "zstd").to_pybytes()
                for w, g in zip(widths, got, strict=True):
                    g.append(_numbers(b[at : at + w * n], n, w))
                    at += w * n
                got[0][-1] = np.cumsum(got[0][-1], dtype=np.uint64)
                marks.append(np.unpackbits(np.frombuffer(b, np.uint8, offset=at), count=n).astype(bool))
            # A part sends a key once, so a key that comes twice is on two pages.
            _, o, heads, count = _ordered([np.concatenate(g) for g in got])
            several = np.empty(len(o), bool)
            several[o] = np.repeat((count > 1) | np.logical_or.reduceat(np.concatenate(marks)[o], heads), count)
            bits = np.split(several, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(parts.to_pylist(), pa.int32()), pa.array([np.array([bucket[0].as_py(), n], "<i4").tobytes() + np.packbits(x).tobytes() for n, x in zip(sizes, bits, strict=True)], pa.binary())], ["part", "bits"])

    n = partitions(sent.sparkSession)
    return sent.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "part int, bits binary").groupBy("part").agg(F.collect_list("bits").alias(name))


def _bits(replies: list[bytes] | None) -> np.ndarray:
    """The bits of a part's keys, in the order of the keys."""
    got = sorted((np.frombuffer(r, "<i4", 2).tolist(), r) for r in replies or [])
    return np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(r, np.uint8, offset=8), count=n).astype(bool) for (_, n), r in got)])


class _Part:
    """The distinct streams of one part, their suffixes' keys, and what is known of them."""

    def __init__(self, blobs: list[bytes], run: int):
        self.run, self.blobs, self.at = run, blobs, {}
        hashes, keys, sizes, held, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], 0

        def hashed():
            n = np.array([t.count(" ") + 1 if t else 0 for _, t in held], np.int64)
            h = _word_hashes(" ".join(t for _, t in held if t).encode("utf-8", "surrogatepass"))
            salts = np.array([xxhash.xxh3_64_intdigest(host.encode("utf-8", "surrogatepass"), 2) for host, _ in held], np.uint64)
            grams, firsts = np.maximum(n - run + 1, 0), np.cumsum(n) - n
            at = np.arange(grams.sum()) + np.repeat(firsts - (np.cumsum(grams) - grams), grams)
            hashes.append(h)
            keys.append(mix(gram_hashes(h, run, 0)[at] ^ np.repeat(salts, grams)))
            sizes.append(n)

        for key, host, texts, _, _ in self.streams():
            if key not in self.at:
                self.at[key] = len(self.at)
                held.append((host, " ".join(texts)))
                size += len(held[-1][1])
                if size > _HASHED:
                    hashed()
                    held, size = [], 0
        if held:
            hashed()
        self.h, self.a, n = np.concatenate(hashes), np.concatenate(keys), np.concatenate(sizes)
        #: Where each stream's suffixes begin, and how many tokens further on its tokens do.
        self.starts = np.r_[0, np.cumsum(np.maximum(n - run + 1, 0))]
        self.shift = np.cumsum(n) - n - self.starts[:-1]

    def streams(self) -> Iterator[tuple]:
        """key, host, blocks, what the check says of them, and the rows that have them: page_id, url."""
        for b in self.blobs:
            yield from marshal.loads(pa.decompress(b[4:], int.from_bytes(b[:4], "little"), "zstd").to_pybytes())

    def page(self, suffixes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, suffixes, "right") - 1

    def distinct(self, keys: list[np.ndarray], suffixes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct keys of suffixes in order, and whether each is on two pages."""
        keys, o, heads, count = _ordered(keys)
        several = count > 1
        some = np.flatnonzero(several)
        first, last = (suffixes[o[heads[some] + k]] for k in (0, count[some] - 1))
        several[some] = self.page(first) != self.page(last)
        return keys, several

    def first(self) -> tuple[list[np.ndarray], np.ndarray]:
        return self.distinct([self.a >> np.uint64(24)], np.arange(len(self.a)))

    def may(self, replies: list[bytes] | None) -> np.ndarray:
        """The suffixes that may be repeated."""
        _, o, _, count = _ordered([self.a >> np.uint64(24)])
        return np.sort(o[np.repeat(_bits(replies), count)])

    def keys(self, some: np.ndarray) -> list[np.ndarray]:
        """All 96 bits of suffixes."""
        at, c = some + self.shift[self.page(some)], np.zeros(len(some), np.uint64)
        for k in range(self.run):
            c = c * _ODD[1] + self.h[at + k]
        return [self.a[some], (mix(c) >> np.uint64(32)).astype(np.uint32)]

    def second(self, some: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        return self.distinct(self.keys(some), some)

    def covered(self, replies: list[bytes] | None, more: list[bytes] | None) -> np.ndarray:
        """The suffixes whose first ``run`` tokens are on two pages."""
        some = self.may(replies)
        _, o, _, count = _ordered(self.keys(some))
        out = np.zeros(len(self.a), bool)
        out[some[o[np.repeat(_bits(more), count)]]] = True
        return out


def _stream_key(host: str, texts: tuple[str, ...]) -> bytes:
    return xxhash.xxh3_128_digest("\n".join((host, *texts)).encode("utf-8", "surrogatepass"))


def extract(pages: DataFrame, run: int = 10, counts: bool = False) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages; with counts, also the page's tokens n_tokens, those that the array covers
    n_repeated, and those of them that the check put back n_restored."""
    n = partitions(pages.sparkSession)
    size = pages.select(F.sum(F.octet_length("html"))).first()[0] or 0
    # Parts by the size of the input: their number's square is the number of blobs of keys.
    parts = buckets = max(8, min(2 * n, -(-size // PART)))

    def parsed(batches):
        held, size = {}, 0

        def out():
            made = [(k, marshal.dumps(list(v.values()))) for k, v in held.items()]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.int32()), pa.array([len(b).to_bytes(4, "little") + _squeezed(b) for _, b in made], pa.binary())], ["part", "blob"])

        for b in slices(batches):
            for page_id, url, page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = judged(page)
                texts = tuple(t for _, t in found)
                host, verdicts = split_url(url)[0], bytes(v for v, _ in found)
                key = _stream_key(host, texts)
                part = held.setdefault(int.from_bytes(key[:8], "little") % parts, {})
                if (key, verdicts) not in part:
                    part[key, verdicts] = (key, host, texts, verdicts, [])
                    size += sum(map(len, texts))
                part[key, verdicts][-1].append((page_id, url))
                size += 100 + len(url or "")
                if size > _HELD:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    # Streams are dealt out once: Spark writes the exchange once and reads it for each of the three steps.
    dealt = src.mapInArrow(parsed, "part int, blob binary").repartition(n, "part").groupBy("part").agg(F.collect_list("blob").alias("blobs"))

    def each(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, blobs, *replies = (b.column(j).slice(i, 1).to_pylist()[0] for j in range(b.num_columns))
                yield part, _Part(blobs, run), replies

    def first(batches):
        for part, p, _ in each(batches):
            keys, several = p.first()
            yield from _sent(part, keys, (5,), several, buckets)

    def second(batches):
        for part, p, (got,) in each(batches):
            keys, several = p.second(p.may(got))
            yield from _sent(part, keys, (8, 4), several, buckets)

    def texts(batches):
        for _, p, (got, more) in each(batches):
            gone, rows, size = p.covered(got, more), [], 0
            for key, _, found, verdicts, ids in p.streams():
                k = p.at[key]
                result = _text(found, verdicts, gone[p.starts[k] : p.starts[k + 1]], run)
                for page_id, url in ids:
                    rows.append((page_id, url, *result))
                    size += 100 + len(result[0])
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4), strict=True)], ["page_id", "url", "text", "n_chars", "n_tokens", "n_repeated", "n_restored"])

    sent = "bucket int, part int, n int, keys binary"
    may = _repeated(dealt.mapInArrow(first, sent), (5,), "may")
    once = dealt.join(may, "part", "left")
    are = _repeated(once.mapInArrow(second, sent), (8, 4), "are")
    out = once.join(are, "part", "left").mapInArrow(texts, "page_id long, url string, text string, n_chars long, n_tokens long, n_repeated long, n_restored long")
    return out if counts else out.select("page_id", "url", "text", "n_chars")


def _text(found: tuple[str, ...], verdicts: bytes, repeated: np.ndarray, run: int) -> tuple[str, int, int, int, int]:
    """The main text, its length, and the stream's tokens, those covered, and those of them that the check put back."""
    sizes = [t.count(" ") + 1 for t in found]
    at = np.flatnonzero(repeated)
    if not len(at):
        text = "\n".join(t for t, v in zip(found, verdicts, strict=True) if v != GONE)
        return text, len(text), sum(sizes), 0, 0
    d = np.zeros(sum(sizes) + 1, np.int64)
    d[at] += 1
    d[at + run] -= 1
    gone, lo, left, restored = np.cumsum(d)[:-1] > 0, 0, [], 0
    upto = np.r_[0, np.cumsum(gone)][np.cumsum([0, *sizes])].tolist()
    for i, (t, v, size) in enumerate(zip(found, verdicts, sizes, strict=True)):
        if v == KEPT:
            left.append(t)
            restored += upto[i + 1] - upto[i]
        elif v == OPEN and (kept := [w for w, g in zip(t.split(), gone[lo : lo + size].tolist(), strict=True) if not g]):
            left.append(" ".join(kept))
        lo += size
    text = "\n".join(left)
    return text, len(text), sum(sizes), upto[-1], restored
