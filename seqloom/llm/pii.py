"""Personal data by rules and a skip-chain conditional random field over whole documents."""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqloom.llm.common import bounded_sample

#: The kinds of personal data, in order. Label 0 of the field is none of them.
KINDS = ("email", "ip", "card", "phone")
#: Documents that the field is fitted on, of those that hold a candidate: the bound of the training sample.
TRAIN_ROWS = 2000
#: Features that a label needs to be seen with before it counts as known.
SMOOTHING = 0.5
LEARNING_STEPS = 300
#: The change of a message below which it is not passed on. Messages that swing in loops for ever end at so many updates of each on average.
TOLERANCE = 1e-4
MOST_UPDATES = 400
#: A token is added with this belief.
LEAST_BELIEF = 0.9
#: Digits from the end that make two numbers alike.
ALIKE_DIGITS = 7

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
#: What the field labels: runs without white space that hold a digit or an at sign.
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_EDGE = "\"'`.,;:!?()[]{}<>#$%&*|"
_CANDIDATE = "[0-9@]"


class Span(NamedTuple):
    start: int
    end: int
    kind: int


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(map(int, reversed(digits))):
        total += digit if k % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Matches of the rules that pass their checks, and those that fail. Each rule reads the text in linear time."""
    good: list[Span] = []
    bad: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            good.append(Span(start, domain.end(), 0))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for chain in _CHAIN.finditer(text):
        parts = [(m.start() + chain.start(), m.end() + chain.start()) for m in re.finditer("[0-9]+", chain[0])]
        for k in range(0, len(parts) - 3, 4):
            small = all(len(text[s:e].lstrip("0")) <= 3 and int(text[s:e].lstrip("0") or 0) <= 255 for s, e in parts[k : k + 4])
            (good if small else bad).append(Span(parts[k][0], parts[k + 3][1], 1))
    for match in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(match[0]))
        (good if 14 <= len(digits) <= 19 and luhn(digits) else bad).append(Span(*match.span(), 2))
    for match in _PHONE.finditer(text):
        (good if 10 <= len(_DIGITS.findall(match[0])) <= 15 else bad).append(Span(*match.span(), 3))
    return sorted(good, key=lambda s: (s.start, s.kind)), bad


class Tokens(NamedTuple):
    """Candidate tokens of a text without the marks around them, and their features."""

    spans: list[tuple[int, int]]
    features: list[tuple[str, ...]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def read_tokens(text: str) -> Tokens:
    """Tokens, links between neighbours, and skip links from each token to the last one equal or alike before it."""
    spans, features, chain, skip = [], [], [], []
    last: dict[tuple[str, str], int] = {}
    behind = -1
    for match in _TOKEN.finditer(text):
        word = match[0]
        start = match.start() + len(word) - len(word.lstrip(_EDGE))
        end = max(start + 1, match.start() + len(word.rstrip(_EDGE)))
        core, k = text[start:end], len(spans)
        spans.append((start, end))
        features.append(_features(text, start, end, core))
        if behind >= 0 and not text[behind : match.start()].strip():
            chain.append((k - 1, k))
        behind = match.end()
        digits = "".join(_DIGITS.findall(core))
        names = [("same", core.lower())]
        if len(digits) >= ALIKE_DIGITS and not any(c.isalpha() for c in core):
            names.append(("digits", digits[-ALIKE_DIGITS:]))
        if "@" in core:
            names += [("name", core.lower().partition("@")[0])]
        linked = {last[n] for n in names if n in last}
        skip += [(j, k) for j in sorted(linked)]
        last.update(dict.fromkeys(names, k))
    return Tokens(spans, features, chain, skip)


def _features(text: str, start: int, end: int, core: str) -> tuple[str, ...]:
    digits = len(_DIGITS.findall(core))
    shape = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]+", "9", core))
    local, at, domain = core.partition("@")
    return (
        "shape " + (shape if len(shape) <= 12 else "long"),
        f"digits {min(digits, 20)}",
        f"letters {sum(map(str.isalpha, core)) > 0} {sum(map(str.isalpha, core)) > 12}",
        f"at {at != ''} {local != ''} {'.' in domain}",
        f"dots {min(core.count('.'), 4)}",
        f"plus {core.startswith('+')}",
        f"brackets {text[max(0, start - 1) : start] == '('} {text[end : end + 1] == ')'}",
    )


class Field(NamedTuple):
    """Weights: of features by label, of neighbours and of skip links by pairs of labels."""

    names: dict[str, int]
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def labels_of(tokens: Tokens, good: list[Span], bad: list[Span]) -> tuple[np.ndarray, np.ndarray]:
    """Labels by the rules (0: none), and for each token the labels that the rules leave open.

    A match that is kept decides its tokens, one that fails its check rules out its kind.
    """
    labels, open_ = np.zeros(len(tokens.spans), int), np.ones((len(tokens.spans), len(KINDS) + 1), bool)
    starts = np.array([s for s, _ in tokens.spans], int)
    ends = np.array([e for _, e in tokens.spans], int)
    for spans, found in ((bad, False), (good, True)):
        for span in spans:
            inside = slice(np.searchsorted(ends, span.start, "right"), np.searchsorted(starts, span.end, "left"))
            if found:
                labels[inside] = span.kind + 1
                open_[inside] = np.arange(len(KINDS) + 1) == span.kind + 1
            else:
                open_[inside, span.kind + 1] = False
    return labels, open_


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Field:
    """A field from at most ``rows`` documents with candidates, chosen by a hash.

    Labels are those of the rules. The weights of features are fitted by gradient descent on the
    tokens' log likelihood, those of links are the log odds of pairs of labels against chance, so
    each part is fitted by itself. Tasks return counts of feature sets and of label pairs.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col(text_col).rlike(_CANDIDATE))
    chosen = bounded_sample(chosen, rows).select("text")

    def count(batches):
        seen: dict[tuple[str, str, int], int] = {}
        for batch in batches:
            for text in batch.column(0):
                tokens = read_tokens(text.as_py())
                labels, _ = labels_of(tokens, *base_spans(text.as_py()))
                rows = [("unary", "\t".join(f), int(y)) for f, y in zip(tokens.features, labels, strict=True)]
                rows += [("chain", str(labels[i]), int(labels[j])) for i, j in tokens.chain]
                rows += [("skip", str(labels[i]), int(labels[j])) for i, j in tokens.skip]
                for row in rows:
                    seen[row] = seen.get(row, 0) + 1
        if seen:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*seen, strict=True)), pa.array(seen.values())], ["part", "what", "label", "times"])

    schema = "part string, what string, label long, times long"
    counts = chosen.mapInArrow(count, schema).groupBy("part", "what", "label").agg(F.sum("times").alias("times"))
    return _fitted(sorted(map(tuple, counts.collect())))


def _fitted(counts: Iterable[tuple[str, str, int, int]]) -> Field:
    size = len(KINDS) + 1
    pairs = {part: np.full((size, size), SMOOTHING) for part in ("chain", "skip")}
    names: dict[str, int] = {}
    examples = []
    for part, what, label, times in counts:
        if part == "unary":
            examples.append(([names.setdefault(f, len(names)) for f in what.split("\t")], label, times))
        else:
            pairs[part][int(what), label] += times
            pairs[part][label, int(what)] += times
    unary = np.zeros((len(names) + 1, size))
    if examples:
        x = np.zeros((len(examples), len(names)))
        for k, (features, _, _) in enumerate(examples):
            x[k, features] = 1
        y = np.eye(size)[[label for _, label, _ in examples]]
        weight = np.array([times for _, _, times in examples], float)
        # shares of labels for every feature set, fitted with a penalty that keeps rare ones small
        step = weight.sum() / 4 * (x.sum(axis=1).max() + 1)
        bias, w, momentum = np.zeros(size), np.zeros((len(names), size)), 0
        for _ in range(LEARNING_STEPS):
            gap = (y - _softmax(x @ w + bias)) * weight[:, None]
            grad = np.vstack([x.T @ gap - SMOOTHING * w, gap.sum(axis=0)])
            momentum = 0.9 * momentum + grad / step
            w, bias = w + momentum[:-1], bias + momentum[-1]
        unary = np.vstack([w, bias])
    odds = {}
    for part, table in pairs.items():
        share = table / table.sum()
        odds[part] = np.log(share / np.outer(share.sum(axis=1), share.sum(axis=0)))
    return Field(names, unary, odds["chain"], odds["skip"])


def _softmax(logs: np.ndarray) -> np.ndarray:
    weights = np.exp(logs - logs.max(axis=1, keepdims=True))
    return weights / weights.sum(axis=1, keepdims=True)


def beliefs(field: Field, tokens: Tokens, open_: np.ndarray) -> np.ndarray:
    """Beliefs in the labels of all tokens of a document, by loopy sum-product message passing.

    Labels that are not open have no weight, so tokens that the rules have decided pass their labels on. Messages are computed
    until none changes; a round takes only those whose input has changed, so a label that moves along a chain of repeats costs
    a few updates a link, and time and memory grow with the number of links.
    """
    rows = [[field.names[f] for f in fs if f in field.names] for fs in tokens.features]
    logs = np.array([field.unary[r].sum(axis=0) for r in rows]) + field.unary[-1]
    logs[~open_] = -60.0
    links = np.array(tokens.chain + tokens.skip, int).reshape(-1, 2)
    if len(links):
        tables = np.concatenate([np.repeat(t[None], n, axis=0) for t, n in ((field.chain, len(tokens.chain)), (field.skip, len(tokens.skip)))])
        source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        by_source = np.argsort(source, kind="stable")
        first = np.searchsorted(source[by_source], np.arange(len(logs) + 1))
        messages = np.zeros((len(source), logs.shape[1]))
        total, now, left = logs.copy(), np.arange(len(source)), MOST_UPDATES * len(source)
        while len(now) and left > 0:
            left -= len(now)
            out = (total[source[now]] - messages[back[now]])[:, :, None] + tables[now]
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = new - messages[now]
            # half of the old message keeps loops from swinging
            messages[now] += change / 2
            np.add.at(total, target[now], change / 2)
            moved = now[np.abs(change).max(axis=1) >= TOLERANCE]
            nodes = np.unique(target[moved])
            counts = first[nodes + 1] - first[nodes]
            places = np.arange(counts.sum()) + np.repeat(first[nodes] - np.cumsum(counts) + counts, counts)
            now = np.unique(np.concatenate([moved, by_source[places]]))
        np.add.at(logs, target, messages)
    return _softmax(logs)


def find(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of a text, by start and kind: matches of the rules, and what the field adds.

    Neighbouring tokens of one label are one span. Added spans never overlap a match of the rules.
    """
    good, bad = base_spans(text)
    found = [(s.start, s.kind, s.end, True) for s in good]
    tokens = read_tokens(text)
    labels, open_ = labels_of(tokens, good, bad)
    known = labels > 0
    if not known.all():
        belief = beliefs(field, tokens, open_)
        chosen = np.where(belief.max(axis=1) >= LEAST_BELIEF, belief.argmax(axis=1), 0)
        chosen[known] = 0
        beside = {j for _, j in tokens.chain}
        for k in np.flatnonzero(chosen).tolist():
            start, end = tokens.spans[k]
            if k in beside and chosen[k - 1] == chosen[k]:
                found[-1] = (*found[-1][:2], end, False)
            else:
                found.append((start, int(chosen[k]) - 1, end, False))
    return [(KINDS[kind], start, end, base) for start, kind, end, base in sorted(found)]


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]
)


def personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for every row of ``docs``: kind, start, end (code points, end exclusive) and whether a rule matched.

    Spans are in the order of start and kind. Null and empty texts have none; repeated rows and null
    ids are returned each time; an empty table gives no rows. Other columns are not read. Texts
    without a digit or an at sign cannot hold a span and are not sent to Python.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("spans", T.ArrayType(SPAN))])
    kinds = to_arrow_schema(schema)
    field = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(SPAN.names, s, strict=True)) for s in find(t, field.value)] if (t := text.as_py()) else [] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kinds[1].type)], kinds.names)

    some = F.when(F.col(text_col).rlike(_CANDIDATE), F.col(text_col))
    return docs.select(id_col, some.alias("__text")).mapInArrow(run, schema)
