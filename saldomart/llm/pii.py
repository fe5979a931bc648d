"""Personal data in texts: fixed patterns, and a skip-chain conditional random field.

The patterns give the base spans. They miss entities that stand side by side, because a
pattern reads on into its neighbour and the whole then fails its check. The field labels
tokens instead. Its nodes are the tokens with a digit or an at sign; all other tokens are
outside by construction. Neighbours in the text share a potential, and so do, however far
apart, tokens of a document with the same text or the same shape; each is linked to the
next such token, so links grow with the tokens and not with their square. Loopy message
passing runs over all links of a document. Labelled tokens give spans if their text has
the form of the kind, or repeats a token of a span found before.

The weights are fitted to the base spans of a bounded sample of documents, by the
likelihood of each label given its neighbours'. Tokens of failed matches that ran over
several tokens say nothing about their labels and are left out there.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldomart.llm.common import batch, sha256_hex, texts_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCUMENTS = 20_000  # with a digit or at sign, for fitting
FEATURES = 1 << 14
ROUNDS = 10  # of message passing
_STEPS, _RATE, _PENALTY = 300, 0.5, 1e-4

# Fixed values of the contract. The look-behind changes no match, it saves hopeless starts.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TOKEN = re.compile(r"\S+")
_CLUE = re.compile("[0-9@]")
_PARTS = re.compile(r"[0-9]+|[^\W\d_]+|[^0-9]")
_EMAIL_TOKEN = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"[0-9]+(\.[0-9]+){3}")
_MOST_TOKENS = (1, 1, 19, 15)  # by kind: the form allows no blank, or so many digits, and a token has one at least
_EDGE = ".,;:!?%$#&*|<>\"'=[]{}/\\"

Span = tuple[int, int, int]  # start, kind, end


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, looked for around each at sign."""
    free = 0  # where the next match may start
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans by start, then kind, and the matches that failed their check."""
    spans, failed = [(a, 0, b) for a, b in _emails(text)], []
    for kind, pattern, check in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        for match in pattern.finditer(text):
            if check(match.group()):
                spans.append((match.start(), kind, match.end()))
            else:
                failed.append(match.span())
    return sorted(spans), failed


def render(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


@dataclass
class Token:
    start: int  # without punctuation at its ends
    end: int
    text: str
    shape: str
    features: tuple[int, int, int]
    touches: bool  # the token before stands right before it


def _shape(text: str) -> str:
    return "".join(
        f"D{len(p)}" if "0" <= p[0] <= "9" else "a" if p[0].isalpha() else p for p in _PARTS.findall(text)
    )


def tokens_of(text: str) -> list[Token]:
    """The tokens with a digit or an at sign."""
    found: list[Token] = []
    last_end = -1
    for match in _TOKEN.finditer(text):
        raw = match.group()
        if not _CLUE.search(raw):
            continue
        left = len(raw) - len(raw.lstrip(_EDGE))
        core = raw.strip(_EDGE)
        if not core:
            continue
        start = match.start() + left
        digits = _digits(core)
        shape = _shape(core)
        address = bool(_ADDRESS.fullmatch(core)) and _is_ip(core)
        flags = min(len(digits), 20), "@" in core, core[0] == "+", core.count("."), _is_card(core), address
        features = (
            0,
            1 + zlib.crc32(shape.encode()) % (FEATURES - 1),
            1 + zlib.crc32(repr(flags).encode()) % (FEATURES - 1),
        )
        gap = text[last_end : match.start()] if last_end >= 0 else ""
        touches = gap.isspace() and "\n" not in gap
        found.append(Token(start, start + len(core), core, shape, features, touches))
        last_end = match.end()
    return found


def links_of(tokens: list[Token]) -> list[tuple[int, int, int]]:
    """Pairs of tokens that share a potential: 0 side by side, 1 same text, 2 same shape."""
    links = [(i - 1, i, 0) for i, t in enumerate(tokens) if t.touches and i]
    for kind, key in ((1, "text"), (2, "shape")):
        last: dict[str, int] = {}
        for i, token in enumerate(tokens):
            value = getattr(token, key)
            if value in last:
                links.append((last[value], i, kind))
            last[value] = i
    return links


def touching(tokens: list[Token], spans: list[tuple[int, int, int]]) -> Iterator[list[int]]:
    """For each token the numbers of the spans (start, kind, end), sorted by start, that share a character with it."""
    near: list[int] = []
    following = 0
    for t in tokens:
        while following < len(spans) and spans[following][0] < t.end:
            near.append(following)
            following += 1
        near = [n for n in near if spans[n][2] > t.start]  # tokens come in order: what ended is behind them all
        yield near


def token_labels(tokens: list[Token], spans: list[Span], failed: list[tuple[int, int]]) -> list[int]:
    """0 outside, 1 + kind inside a base span, -1 unknown: part of a failed match of several tokens."""
    matches = sorted((a, 0, b) for a, b in failed)
    of_failed = [list(near) for near in touching(tokens, matches)]
    n_tokens = [0] * len(matches)
    for near in of_failed:
        for n in near:
            n_tokens[n] += 1
    labels = []
    for inside, near in zip(touching(tokens, spans), of_failed):
        if inside:
            labels.append(1 + spans[inside[0]][1])
        else:
            labels.append(-1 if any(n_tokens[n] > 1 for n in near) else 0)
    return labels


@dataclass
class Field:
    """Weights of the labels by feature, and of pairs of labels by kind of link."""

    single: np.ndarray  # FEATURES x 5
    pair: np.ndarray  # 3 x 5 x 5


def _normal(scores: np.ndarray) -> np.ndarray:
    top = scores.max(axis=-1, keepdims=True)
    return scores - top - np.log(np.exp(scores - top).sum(axis=-1, keepdims=True))


def fit(features: np.ndarray, links: np.ndarray, labels: np.ndarray) -> Field:
    """Ascend the likelihood of each known label given the known labels it is linked to."""
    field = Field(np.zeros((FEATURES, 5)), np.zeros((3, 5, 5)))
    if not len(labels):
        return field
    used, at = np.unique(features, return_inverse=True)
    at = at.reshape(features.shape)
    single, known = np.zeros((len(used), 5)), labels >= 0
    both = known[links[:, 0]] & known[links[:, 1]] if len(links) else np.zeros(0, bool)
    u, v, kind = links[both].T if both.any() else np.zeros((3, 0), int)
    truth = np.eye(5)[np.maximum(labels, 0)] * known[:, None]
    n = max(1, int(known.sum()))
    speed, pair_speed = np.full(single.shape, 1e-8), np.full(field.pair.shape, 1e-8)
    for _ in range(_STEPS):
        scores = single[at].sum(axis=1)
        for a, b, w in ((u, v, field.pair[kind]), (v, u, field.pair[kind].transpose(0, 2, 1))):
            np.add.at(scores, b, w[np.arange(len(a)), labels[a]])
        error = (truth - np.exp(_normal(scores)) * known[:, None]) / n
        step = np.zeros_like(single)
        for column in at.T:
            np.add.at(step, column, error)
        step -= _PENALTY * single
        pair_step = np.zeros_like(field.pair)
        np.add.at(pair_step, (kind, labels[u]), error[v])
        turned = np.zeros_like(field.pair)
        np.add.at(turned, (kind, labels[v]), error[u])
        pair_step += turned.transpose(0, 2, 1) - _PENALTY * field.pair
        speed += step**2
        pair_speed += pair_step**2
        single += _RATE * step / np.sqrt(speed)
        field.pair += _RATE * pair_step / np.sqrt(pair_speed)
    field.single[used] = single
    return field


def label_tokens(features: np.ndarray, links: np.ndarray, field: Field) -> np.ndarray:
    """The likeliest label of each token after message passing over all links."""
    scores = field.single[features].sum(axis=1)
    if not len(links):
        return scores.argmax(axis=1)
    u, v, kind = links.T
    source, target = np.r_[u, v], np.r_[v, u]
    weights = np.concatenate([field.pair[kind], field.pair[kind].transpose(0, 2, 1)])
    back = np.r_[np.arange(len(u), 2 * len(u)), np.arange(len(u))]
    messages = np.zeros((2 * len(u), 5))
    for _ in range(ROUNDS):
        belief = scores.copy()
        np.add.at(belief, target, messages)
        inner = (belief[source] - messages[back])[:, :, None] + weights
        top = inner.max(axis=1, keepdims=True)
        messages = (messages + _normal(np.log(np.exp(inner - top).sum(axis=1)) + top[:, 0])) / 2
    belief = scores.copy()
    np.add.at(belief, target, messages)
    return belief.argmax(axis=1)


def _has_form(kind: int, text: str) -> bool:
    if kind == 0:
        return bool(_EMAIL_TOKEN.fullmatch(text))
    if kind == 1:
        return bool(_ADDRESS.fullmatch(text)) and _is_ip(text)
    if kind == 2:
        return bool(_CARD.fullmatch(text)) and _is_card(text)
    return bool(re.fullmatch(r"[+(]?[0-9][\x20().0-9-]+[0-9]", text)) and _is_phone(text)


def _parts_with_form(kind: int, text: str, run: list[Token]) -> tuple[list[Span], list[list[Token]]]:
    """All parts of a run that have the form, the longest first, then from the left, and what is left between them."""
    hits, rest = [], [run]
    for size in range(min(len(run), _MOST_TOKENS[kind]), 0, -1):
        parts, rest = rest, []
        for part in parts:
            begin = first = 0
            while first + size <= len(part):
                start, end = part[first].start, part[first + size - 1].end
                if not _has_form(kind, text[start:end]):
                    first += 1
                    continue
                hits.append((start, kind, end))
                if first > begin:
                    rest.append(part[begin:first])
                begin = first = first + size
            if begin < len(part):
                rest.append(part[begin:])
    return hits, rest


def added_spans(text: str, tokens: list[Token], labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of labelled tokens that no base span touches."""
    near = [list(numbers) for numbers in touching(tokens, base)]
    taken = {t.text for t, numbers in zip(tokens, near) if any(base[n][0] <= t.start and t.end <= base[n][2] for n in numbers)}
    free = [not numbers for numbers in near]
    added: list[Span] = []
    i = 0
    while i < len(tokens):
        kind = int(labels[i]) - 1
        if kind < 0 or not free[i]:
            i += 1
            continue
        j = i + 1  # a run of one kind; a plus sign opens the next phone
        while (
            j < len(tokens) and tokens[j].touches and labels[j] == labels[i] and free[j] and tokens[j].text[0] != "+"
        ):
            j += 1
        hits, rest = _parts_with_form(kind, text, tokens[i:j])
        added += hits
        for part in rest:
            if all(t.text in taken for t in part) and len(_digits("".join(t.text for t in part))) >= 7:
                added.append((part[0].start, kind, part[-1].end))
        i = j
    return added


def _arrays(tokens: list[list[Token]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and links of several documents, and where each document's tokens begin."""
    starts = np.cumsum([0, *map(len, tokens)])
    features = np.array([t.features for ts in tokens for t in ts], np.int64).reshape(-1, 3)
    links = [(a + s, b + s, k) for ts, s in zip(tokens, starts) for a, b, k in links_of(ts)]
    return features, np.array(links, np.int64).reshape(-1, 3), starts


def _clued(docs: DataFrame) -> DataFrame:
    """Texts without a digit or at sign hold nothing to find and need not leave the JVM."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text")
    )


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.list_(pa.int64())) for n in ("features", "links", "labels")])
    for rows in batches:
        columns: list[list] = [[], [], []]
        for text in texts_of(rows.column(0)):
            tokens = tokens_of(text)
            columns[0].append([f for t in tokens for f in t.features])
            columns[1].append([x for link in links_of(tokens) for x in link])
            columns[2].append(token_labels(tokens, *base_spans(text)))
        yield batch(schema, *columns)


def fit_on(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Field:
    """Fit the field on at most ``documents`` distinct texts, those with the lowest hashes."""
    clued = _clued(docs).filter("text IS NOT NULL")
    keys = clued.select(F.xxhash64("text").alias("key")).distinct().orderBy("key").limit(documents)
    bound = keys.agg(F.max("key")).first()[0]
    if bound is None:
        return fit(np.zeros((0, 3), int), np.zeros((0, 3), int), np.zeros(0, int))
    rows = (
        clued.filter(F.xxhash64("text") <= bound)
        .dropDuplicates(["text"])
        .select("text")
        .mapInArrow(_training_rows, "features array<long>, links array<long>, labels array<long>")
        .collect()
    )
    rows.sort(key=lambda r: (r["features"], r["labels"]))
    sizes = np.cumsum([0, *[len(r["labels"]) for r in rows]])
    features = np.array([f for r in rows for f in r["features"]], np.int64).reshape(-1, 3)
    links = [
        np.array(r["links"], np.int64).reshape(-1, 3) + np.array([s, s, 0]) for r, s in zip(rows, sizes) if r["links"]
    ]
    labels = np.array([x for r in rows for x in r["labels"]], np.int64)
    return fit(features, np.concatenate(links) if links else np.zeros((0, 3), np.int64), labels)


FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(f"n_{kind}", pa.int64()) for kind in KINDS],
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_added", pa.int64()),
    ]
)
_COUNTS = ", ".join(f"n_{kind} long" for kind in KINDS)
FOUND_DDL = f"doc_id long, {_COUNTS}, base_sha256 string, spans string, n_added long"


def spans_of_texts(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    tokens = [tokens_of(text) for text in texts]
    features, links, starts = _arrays(tokens)
    labels = label_tokens(features, links, field) if len(features) else np.zeros(0, int)
    found = []
    for text, ts, a, b in zip(texts, tokens, starts[:-1], starts[1:]):
        base = base_spans(text)[0] if text else []
        found.append((base, added_spans(text, ts, labels[a:b], base)))
    return found


def find_pii(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Personal data in the whole text of each row.

    Returns one row per input row: doc_id, the number of base spans of each kind, the
    digest of the base spans, all spans as kind:start:end in code points, and how many the
    field added. NULL and empty texts have none. Repeated rows are repeated, a NULL doc_id
    stays NULL; other columns are ignored. The weights are fitted on at most ``documents``
    distinct texts and broadcast; their size is fixed. No shuffle but that of the sample.
    """
    field = docs.sparkSession.sparkContext.broadcast(fit_on(docs, documents))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                found = spans_of_texts(texts_of(rows.column(1)), field.value)
                yield batch(
                    FOUND,
                    rows.column(0),
                    *[[sum(s[1] == k for s in base) for base, _ in found] for k in range(4)],
                    [sha256_hex(render(base).encode()) for base, _ in found],
                    [render(base + added) for base, added in found],
                    [len(added) for _, added in found],
                )

    return _clued(docs).mapInArrow(find, FOUND_DDL)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans become one."""
    parts, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_pii(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; every other column and row stays as it is."""
    field = docs.sparkSession.sparkContext.broadcast(fit_on(docs, documents))
    at = docs.columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                texts = rows.column(at).to_pylist()
                clued = [i for i, text in enumerate(texts) if text and _CLUE.search(text)]
                found = spans_of_texts([texts[i] for i in clued], field.value)
                for i, (base, added) in zip(clued, found):
                    texts[i] = mask(texts[i], base + added)
                yield rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))

    return docs.mapInArrow(replace, docs.schema)
