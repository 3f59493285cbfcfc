"""Personal data: fixed patterns, widened by a skip-chain conditional random field.

Base spans (email, ip, card, phone) come from linear-time scans.  The field's nodes are the tokens
that could be personal data: those with a digit or "@", those near a spelled-out "dot", and repeats
of an email's local part.  Chain edges join neighbouring nodes; skip edges join a node to the last
one with the same or a similar key (equal text, or the same last digits), so distant mentions of one
thing share potentials.  Nodes inside base spans are clamped to their kind and loopy belief
propagation carries their labels over both kinds of edge; a node whose marginal passes SURE becomes
a span of its own (neighbours of one kind joined).

The field is fitted by pseudo-likelihood on a bounded sample of documents (MAX_DOCS by hash order,
MAX_NODES neighbouring nodes of each, from a place by hash), in which half of the base mentions are rewritten into spellings that the
patterns miss.  Every document is scanned and inferred whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ship

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
MAX_DOCS, MAX_NODES, SURE, ROUNDS = 1500, 200, 0.9, 20

# Fixed patterns of the data contract.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    d = [ord(c) - 48 for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The leftmost non-overlapping matches of each kind that pass its test, kinds in order."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > end and text[s - 1] in _LOCAL:
            s -= 1
        if s < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(Span("email", s, m.end()))
            end = m.end()
        else:
            end = max(end, at)
        at = text.find("@", max(at + 1, end))
    if any(map(text.__contains__, "0123456789")):
        out += [Span("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 16 <= m.end() - m.start() and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append(Span("card", m.start(), m.end()))
        out += [Span("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# --- nodes and edges --------------------------------------------------------------------------

_HOT = re.compile(r"[0-9@]\S*|\b[Dd][Oo][Tt]\b")
_TOKEN = re.compile(r"\S+")
_EDGE = " \t\r\n.,;:!?\"'()[]{}<>#$%&*|"
_KEEP = "()[]"
NEAR = 24
#: Tokens before and after a spelled-out dot that are nodes.
BEFORE, AFTER = 3, 2


class Graph(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    words: list[list[str]]
    clamp: np.ndarray
    edges: np.ndarray  # rows (i, j, 0 chain or 1 skip)


def _tokens(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Spans of the tokens that are nodes. One pass over the text, and one over all tokens where some are needed."""
    found: dict[int, int] = {}
    hot = list(_HOT.finditer(text))
    locals_ = {part for x in base if x.kind == "email" and len(part := text[x.start : x.end].partition("@")[0]) >= 6 and ("." in part or "_" in part)}
    starts, ends = [], []
    if locals_ or any(text[m.start()] in "dD" for m in hot):
        for m in _TOKEN.finditer(text):
            starts.append(m.start())
            ends.append(m.end())
            if m[0] in locals_:
                found[m.start()] = m.end()
    end = 0
    for m in hot:
        if m.start() < end:
            continue
        if text[m.start()] in "dD":  # the tokens around a spelled-out dot
            k = bisect_right(starts, m.start()) - 1
            for i in range(max(0, k - BEFORE), min(len(starts), k + AFTER + 1)):
                if starts[i] >= end:
                    found[starts[i]] = ends[i]
            continue
        s = m.start()
        while s > end and not text[s - 1].isspace():
            s -= 1
        found[s] = end = m.end()
    out, last = [], 0
    for s, e in sorted(found.items()):
        if s >= last:
            out.append((s, e))
            last = e
    return out


def shape(token: str) -> str:
    s = re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", re.sub("[0-9]", "9", token)))
    return re.sub("9{5,}", lambda m: f"9x{len(m[0]) if len(m[0]) < 20 else 20}", s)[:24]


def _features(text: str, s: int, e: int) -> list[str]:
    tok = text[s:e].strip(_EDGE.replace("(", "").replace(")", ""))
    digits = _NOT_DIGIT.sub("", tok)
    before, after = text[max(0, s - NEAR) : s].split(), text[e : e + NEAR].split()
    at = lambda w, k: w[k].strip(_EDGE).lower()[:12] if len(w) >= abs(k + (k >= 0)) else ""
    out = ["bias", f"s:{shape(tok)}", f"n:{min(len(digits), 20)}", f"d:{tok.count('.')}", f"at:{'@' in tok}"]
    for name, w in (("p1", before[-1] if before else ""), ("n1", after[0] if after else "")):
        out.append(f"{name}:{shape(w.strip(_EDGE.replace('(', '').replace(')', ''))) if any(c.isdigit() or c == '@' for c in w) else 'w'}")
    w1, w2 = at(before, -1), at(after, 0)
    out += [f"pw:{w1}" for w1 in [w1] if w1 in _CUES] + [f"nw:{w2}" for w2 in [w2] if w2 in _CUES]
    low = tok.strip(_EDGE).lower()
    out.append(f"w:{low if low in _CUES else '-'}")
    if len(digits) >= 16:
        out.append(f"luhn:{luhn(digits)}")
    if len(tok) > 20 and digits and re.fullmatch(r"[\"']?[0-9a-fA-F]+[\"']?", tok):
        out.append("hex")
    return out


#: Words whose neighbourhood says something (fixed list).
_CUES = frozenset("at dot com net org example email mail e-mail phone tel call fax mobile card visa ip host server address token key id".split())


def _keys(token: str) -> list[str]:
    tok = token.strip(_EDGE).casefold()
    digits = _NOT_DIGIT.sub("", tok)
    out = [tok] if len(tok) >= 5 else []
    if len(digits) >= 7:
        out.append(f"#{digits[-7:]}")
    if "@" in tok:
        out.append(tok.partition("@")[0])
    return out


def graph(text: str, base: list[Span]) -> Graph:
    toks = _tokens(text, base)
    n = len(toks)
    clamp = np.zeros(n, np.int64)
    spans = sorted(base, key=lambda x: x.start)
    k = 0
    for i, (s, e) in enumerate(toks):
        while k < len(spans) and spans[k].end <= s:
            k += 1
        if k < len(spans) and spans[k].start < e:
            clamp[i] = 1 + KINDS.index(spans[k].kind)
    edges, last = [], {}
    for i, (s, e) in enumerate(toks):
        if i and s - toks[i - 1][1] <= 3:
            edges.append((i - 1, i, 0))
        for key in _keys(text[s:e]):
            if key in last and last[key] != i and (not edges or edges[-1][:2] != (last[key], i)):
                edges.append((last[key], i, 1))
            last[key] = i
    return Graph(np.array([t[0] for t in toks], np.int64), np.array([t[1] for t in toks], np.int64), [_features(text, s, e) for s, e in toks], clamp, np.array(edges, np.int64).reshape(-1, 3))


# --- the model --------------------------------------------------------------------------------


class Field(NamedTuple):
    vocab: dict[str, int]
    node: np.ndarray  # features x labels
    pair: np.ndarray  # 2 x labels x labels, symmetric

    def unary(self, words: list[list[str]]) -> np.ndarray:
        v = self.vocab
        return np.array([self.node[[v[w] for w in ws if w in v]].sum(0) for ws in words]).reshape(-1, len(LABELS))

    def marginals(self, g: Graph) -> np.ndarray:
        """Loopy sum-product with damping; clamped nodes keep their label."""
        phi = self.unary(g.words)
        fixed = np.flatnonzero(g.clamp)
        phi[fixed] = -30.0
        phi[fixed, g.clamp[fixed]] = 0.0
        if not len(g.edges):
            return _softmax(phi)
        a = np.concatenate((g.edges[:, 0], g.edges[:, 1]))
        b = np.concatenate((g.edges[:, 1], g.edges[:, 0]))
        kind, m = np.tile(g.edges[:, 2], 2), len(g.edges)
        twin = np.concatenate((np.arange(m, 2 * m), np.arange(m)))
        msg = np.zeros((2 * m, len(LABELS)))
        pots = self.pair[kind]
        for _ in range(ROUNDS):
            total = phi.copy()
            np.add.at(total, b, msg)
            out = total[a] - msg[twin]
            new = _lse(out[:, :, None] + pots, 1)
            new -= new.max(1, keepdims=True)
            done = np.abs(new - msg).max() < 1e-3
            msg = 0.5 * msg + 0.5 * new
            if done:
                break
        total = phi.copy()
        np.add.at(total, b, msg)
        return _softmax(total)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def respell(kind: str, s: str, pick: int) -> str:
    """A spelling of a mention that the patterns miss."""
    if kind == "email":
        local, _, domain = s.partition("@")
        return [f"{local} at {domain.replace('.', ' dot ')}", f"{local}[at]{domain}", f"{local}(at){domain}", f"{local} @ {domain}"][pick % 4]
    if kind == "ip":
        return s.replace(".", ["[.]", "(.)", " . "][pick % 3])
    d = _NOT_DIGIT.sub("", s)
    if kind == "card":
        return ["/", ".", "_"][pick % 3].join(d[i : i + 4] for i in range(0, len(d), 4))
    t = d[-10:]
    return [f"({t[:3]}) {t[3:6]}-{t[6:]}", f"{t[:3]}-{t[3:6]}-{t[6:]}", f"{t[:3]}.{t[3:6]}.{t[6:]}", f"00{d[:-10]} {t[:3]} {t[3:6]} {t[6:]}"][pick % 4]


#: Ordinary words that look like spelled-out addresses or numbers (fixed list); they teach what isn't personal.
_DECOYS = ("at the dot of", "a dot on", "dot com", "look at dot", "the red dot at", "in 1999", "about 500 at", "version 3.4", "of 12 to 15", "1999-2004")


def training_graph(text: str) -> Graph:
    """The document's graph with true labels in `clamp`, half of the mentions respelled, and a decoy put in."""
    out, spans, at = [], [], 0
    n = 0
    if (cut := text.find(" ", zlib.crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(text)))) >= 0:
        text = f"{text[:cut]} {_DECOYS[cut % len(_DECOYS)]}{text[cut:]}"
    for x in sorted(base_spans(text), key=lambda x: x.start):
        if x.start < at:
            continue
        mention = text[x.start : x.end]
        pick = zlib.crc32(f"{x.start}:{mention}".encode())
        new = respell(x.kind, mention, pick >> 1) if pick & 1 else mention
        out += [text[at : x.start], new]
        n += x.start - at
        spans.append(Span(x.kind, n, n + len(new)))
        n += len(new)
        at = x.end
    return graph("".join([*out, text[at:]]), spans)


def fit_field(graphs: list[Graph], rounds: int = 300, l2: float = 0.02) -> Field:
    """Pseudo-likelihood: each node given its neighbours' true labels; pair weights are symmetric."""
    vocab: dict[str, int] = {}
    rows, labels, near = [], [], []
    for g in graphs:
        counts = np.zeros((len(g.words), 2, len(LABELS)))
        for i, j, k in g.edges:
            counts[i, k, g.clamp[j]] += 1
            counts[j, k, g.clamp[i]] += 1
        for ws, y, c in zip(g.words, g.clamp, counts, strict=True):
            rows.append([vocab.setdefault(w, len(vocab)) for w in ws])
            labels.append(y)
            near.append(c)
    size = len(LABELS)
    node, pair = np.zeros((len(vocab), size)), np.zeros((2, size, size))
    pair[0] = 0.5 * np.eye(size)
    pair[1] = 1.0 * np.eye(size)
    if not rows:
        return Field(vocab, node, pair)
    idx, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    y, c = np.eye(size)[np.array(labels)], np.array(near)
    n = len(rows)
    gn, gp = np.full_like(node, 1e-8), np.full_like(pair, 1e-8)
    for _ in range(rounds):
        eta = np.zeros((n, size))
        np.add.at(eta, of, node[idx])
        eta += np.einsum("nka,kab->nb", c, pair)
        r = (_softmax(eta) - y) / n
        dn = np.zeros_like(node)
        np.add.at(dn, idx, r[of])
        dn += l2 * node / len(vocab)
        dp = np.einsum("nka,nb->kab", c, r)
        dp = (dp + dp.transpose(0, 2, 1)) / 2 + l2 * (pair - np.eye(size)) / size**2
        gn += dn**2
        gp += dp**2
        node -= 0.3 * dn / np.sqrt(gn)
        pair -= 0.1 * dp / np.sqrt(gp)
    return Field(vocab, node, pair)


def fit(docs: DataFrame, text_col: str = "text", most: int = MAX_DOCS) -> Field:
    """The field from at most `most` documents with a digit or "@", by hash order."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    some = docs.select(text.alias("text")).where(F.col("text").rlike("@[A-Za-z0-9-]+\\.|[0-9]{4}|[0-9]\\.[0-9]+\\.")).select("text", F.xxhash64("text").alias("h"))
    chosen = some.select("h").distinct().orderBy("h").limit(most)
    sample = some.join(F.broadcast(chosen), "h", "left_semi")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h, t in zip(b["h"], b["text"], strict=True):
                g = training_graph(t)
                n = min(len(g.words), MAX_NODES)
                at = h % (len(g.words) - n + 1)
                e = g.edges[((g.edges[:, :2] >= at) & (g.edges[:, :2] < at + n)).all(1)] - [at, at, 0]
                if n:
                    out.append((h, g.words[at : at + n], g.clamp[at : at + n].tolist(), e.ravel().tolist()))
            yield pd.DataFrame(out, columns=["h", "words", "labels", "edges"])

    got = sample.mapInPandas(make, "h long, words array<array<string>>, labels array<long>, edges array<long>").dropDuplicates(["h"]).orderBy("h").collect()  # at most `most` rows of MAX_NODES nodes
    none = np.zeros(0, np.int64)
    return fit_field([Graph(none, none, r["words"], np.array(r["labels"], np.int64), np.array(r["edges"], np.int64).reshape(-1, 3)) for r in got])


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """What the field finds beyond the base spans; never overlapping one."""
    g = graph(text, base)
    free = np.flatnonzero(g.clamp == 0)
    if not len(free):
        return []
    p = field.marginals(g)
    out: list[Span] = []
    for i in free:
        k = int(p[i].argmax())
        if not k or p[i, k] < SURE:
            continue
        s, e = int(g.start[i]), int(g.end[i])
        while e > s and text[e - 1] in _EDGE and text[e - 1] not in ")]":
            e -= 1
        while s < e and text[s] in _EDGE and text[s] not in "([":
            s += 1
        if s >= e:
            continue
        if out and out[-1].kind == KINDS[k - 1] and s - out[-1].end <= 2 and not text[out[-1].end : s].strip():
            out[-1] = Span(out[-1].kind, out[-1].start, e)
        else:
            out.append(Span(KINDS[k - 1], s, e))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x.kind), x.start, x.end)))


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row.

    Counts and hash are those of the base spans; `spans` also lists what the field adds.  A null text
    is empty and has no spans; repeated rows are found alike; offsets are code points, ends exclusive.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b["text"]:
                base = base_spans(t or "")
                n = [sum(x.kind == k for x in base) for k in KINDS]
                extra = added_spans(t, base, field) if t else []
                rows.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + extra)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]).assign(doc_id=b["doc_id"].astype("Int64"))[["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]]

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str | None, field: Field) -> str | None:
    """The text with every span replaced by its kind; overlapping spans become one."""
    if not text:
        return text
    base = base_spans(text)
    spans = sorted(base + added_spans(text, base, field), key=lambda x: (x.start, -x.end))
    out, at = [], 0
    for x in spans:
        if x.start >= at:
            out += [text[at : x.start], f"[{x.kind.upper()}]"]
        at = max(at, x.end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The same rows and columns with personal data masked in the text; null stays null."""
    ship(docs.sparkSession)
    hide = F.pandas_udf(lambda s: pd.Series([masked(t, field) for t in s], dtype=object), "string")
    return docs.withColumn(text_col, hide(F.col(text_col).cast("string")))
