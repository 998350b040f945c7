"""Personal data: written formats, and a semi-Markov conditional random field that adds spans.

The formats (``base_spans``) always count. The field looks at *islands*: runs of
neighbouring words of which each has a digit or an @. A segment is one to
``MAX_WORDS`` words of an island. Whole-span features (shape, digit groups, checks,
words before it) score a segment as e-mail, address, card, phone or none, and
dynamic programming over bounded segments sums all segmentations; it chooses
boundaries and kinds together and gives each segment's probability. Segments of
the best segmentation that are at least ``CERTAIN`` likely and touch no base span
are added.

Weights are learned by stochastic gradient on the conditional likelihood, from
labelled islands: ``default_islands`` (seeded, by written format, with look-alikes)
and at most ``TRAIN_DOCS`` documents whose base spans are the labels (a documented
bound; in hash order of the id, one row an id, the first ``PER_TEXT`` islands of each). Finding reads every whole text, in one pass
without a shuffle.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, table

KINDS = ("email", "ip", "card", "phone")
NONE = "none"
MAX_WORDS = 6
MAX_CHARS = 80
# Longer islands are read in windows of this many words, which bounds the table of the dynamic program. A window decides
# on the spans that begin inside it, MARGIN words away from where it was cut; its neighbours, which overlap it, on the rest.
WINDOW = 200
MARGIN = 20
CERTAIN = 0.95
TRAIN_DOCS = 600
EPOCHS = 4
RATE = 0.2
DECAY = 1e-4

# The written formats. Possessive repeats give the same matches and keep long runs linear.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CUES = {
    "phone": ("phone", "tel", "telephone", "call", "fax", "mobile", "cell", "whatsapp"), "email": ("email", "mail", "e-mail", "contact", "write"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit"), "ip": ("ip", "host", "server", "address", "from", "ping"),
    NONE: ("order", "invoice", "version", "isbn", "no", "number", "page", "id", "ref", "on", "at", "in", "price", "v"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(x: str) -> str:
    return "".join(c for c in x if "0" <= c <= "9")


def octets(x: str) -> bool:
    """Four dotted numbers of at most 255 (leading zeros don't count as size)."""
    parts = [p.lstrip("0") for p in x.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the written formats, leftmost and without overlap by kind, in the order of ``KINDS``."""
    out = []
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    out += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = only_digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return out


def islands(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring words (start, end) with a digit or an @, edge marks cut off."""
    pos, words, last = 0, [], -1
    while True:
        m = ANCHOR.search(text, pos)
        if not m:
            break
        a = m.start()
        while a > pos and not text[a - 1] in " \t\n\x0b\x0c\r":
            a -= 1
        b = WORD.match(text, m.start()).end()
        pos = b
        if words and a - last > 1:
            yield words
            words = []
        last = b
        while b > a and text[b - 1] in ".,;:!?\"'>]}":
            b -= 1
        while a < b and text[a] in "\"'<[{":
            a += 1
        if a < b:
            words.append((a, b))
    if words:
        yield words


def shape(x: str) -> str:
    """Digit groups and marks of a span, letters as x."""
    x = re.sub(r"[A-Za-z]+", "x", x[:MAX_CHARS])
    return re.sub(r"[0-9]+", lambda m: f"d{min(len(m.group()), 20)}", x)


def span_features(text: str, a: int, b: int) -> list[str]:
    """Features of a whole segment."""
    x = text[a:b]
    digits = only_digits(x)
    before = WORD.findall(text[max(0, a - 30) : a])
    cue = before[-1].lower().strip(".,:;()#") if before else ""
    out = [
        "bias", f"s={shape(x)}", f"n={min(len(digits), 20)}", f"w={x.count(' ')}", f"first={x[0] if not x[0].isalnum() else 'd' if x[0].isdigit() else 'x'}",
        f"@={min(x.count('@'), 2)}", f"dots={min(x.count('.'), 4)}", f"letters={any(c.isalpha() for c in x)}",
        f"marks={''.join(sorted(set(re.sub(r'[A-Za-z0-9 ]', '', x))))[:6]}",
    ]
    if len(digits) == len(x.replace(" ", "").replace("-", "")) and len(digits) >= 12:
        out.append(f"luhn={luhn(digits)}")
    if x.count(".") == 3 and not any(c.isalpha() for c in x):
        out.append(f"octets={octets(x) if re.fullmatch(r'[0-9]+([.][0-9]+){3}', x) else False}")
    for kind, cues in CUES.items():
        if cue in cues:
            out.append(f"cue={kind}")
    return out


def candidates(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
    """(first word, end word, features) of all bounded segments."""
    out = []
    for i in range(len(words)):
        for j in range(i + 1, min(len(words), i + MAX_WORDS) + 1):
            if words[j - 1][1] - words[i][0] > MAX_CHARS and j > i + 1:
                break
            out.append((i, j, span_features(text, words[i][0], words[j - 1][1])))
    return out


class SemiMarkov:
    """Segment weights by (kind, feature), with the exact sums and the best segmentation."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def scores(self, segments) -> list[tuple[int, int, str, float, list[str]]]:
        """Scored (first, end, kind): entities of any length, ``none`` one word at a time."""
        get = self.weights.get
        return [
            (i, j, kind, sum(get((kind, f), 0.0) for f in feats), feats)
            for i, j, feats in segments for kind in ((*KINDS, NONE) if j == i + 1 else KINDS)
        ]

    def marginals(self, scored, n: int) -> list[float]:
        """Probability of each scored segment (forward and backward sums)."""
        ends, starts = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
        for k, (i, j, _, _, _) in enumerate(scored):
            ends[j].append(k)
            starts[i].append(k)

        def total(values: list[float]) -> float:
            top = max(values)
            return top + math.log(sum(math.exp(v - top) for v in values))

        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = total([forward[scored[k][0]] + scored[k][3] for k in ends[j]])
        for i in range(n - 1, -1, -1):
            backward[i] = total([scored[k][3] + backward[scored[k][1]] for k in starts[i]])
        return [math.exp(forward[i] + s + backward[j] - forward[n]) for i, j, _, s, _ in scored]

    def best(self, scored, n: int) -> list[int]:
        """The segments of the best segmentation."""
        value, back = [0.0] + [-math.inf] * n, [-1] * (n + 1)
        ends = [[] for _ in range(n + 1)]
        for k, seg in enumerate(scored):
            ends[seg[1]].append(k)
        for j in range(1, n + 1):
            for k in ends[j]:
                v = value[scored[k][0]] + scored[k][3]
                if v > value[j]:
                    value[j], back[j] = v, k
        out, j = [], n
        while j > 0:
            out.append(back[j])
            j = scored[back[j]][0]
        return out

    def find(self, text: str, certain: float = CERTAIN) -> list[tuple[str, int, int]]:
        """Spans (kind, start, end) of all islands, in order and without overlap."""
        out: list[tuple[str, int, int]] = []
        for island in islands(text):
            for lo in range(0, max(1, len(island) - 2 * MARGIN), WINDOW - 2 * MARGIN):
                hi = min(len(island), lo + WINDOW)
                first = lo + MARGIN if lo else 0
                after = hi - MARGIN if hi < len(island) else hi
                for kind, i, j in self._found(text, island[lo:hi], certain):
                    a = island[lo + i][0]
                    if first <= lo + i < after and (not out or out[-1][2] <= a):
                        out.append((kind, a, island[lo + j - 1][1]))
        return out

    def _found(self, text: str, words: list[tuple[int, int]], certain: float) -> list[tuple[str, int, int]]:
        """(kind, first word, end word) of the best segmentation's certain entities."""
        scored = self.scores(candidates(text, words))
        chosen = [k for k in self.best(scored, len(words)) if scored[k][2] != NONE]
        if not chosen:
            return []
        p = self.marginals(scored, len(words))
        return sorted(((scored[k][2], scored[k][0], scored[k][1]) for k in chosen if p[k] >= certain), key=lambda x: x[1])


def train(examples: list[tuple[str, list[tuple[int, int]], list[tuple[str, int, int]]]], epochs: int = EPOCHS, seed: int = 2) -> SemiMarkov:
    """Learn from (text, island words, true spans) by gradient steps on the conditional likelihood.

    A true span that is no run of the island's words teaches nothing.
    """
    model = SemiMarkov()
    ready = []
    for text, words, spans in examples:
        segments = candidates(text, words)
        true = {(a, b): kind for kind, a, b in spans}
        covered: set[int] = set()
        gold = set()
        for i, j, _ in segments:
            kind = true.get((words[i][0], words[j - 1][1]))
            if kind and not covered & set(range(i, j)):
                gold.add((i, j, kind))
                covered |= set(range(i, j))
        gold |= {(i, i + 1, NONE) for i in range(len(words)) if i not in covered}
        ready.append((segments, gold, len(words)))
    rng = random.Random(seed)
    for epoch in range(epochs):
        rng.shuffle(ready)
        rate = RATE / (1 + epoch)
        for segments, gold, n in ready:
            scored = model.scores(segments)
            for (i, j, kind, _, feats), p in zip(scored, model.marginals(scored, n)):
                g = ((i, j, kind) in gold) - p
                if abs(g) > 1e-4:
                    for f in feats:
                        w = model.weights.get((kind, f), 0.0)
                        model.weights[kind, f] = w + rate * (g - DECAY * w)
    return model


def default_islands(seed: int = 4, each: int = 60) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled texts by written format, with numbers that are no personal data."""
    rng = random.Random(seed)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("aeinorstlmk") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        body = rng.choice("45") + d(14)
        return next(body + str(k) for k in range(10) if luhn(body + str(k)))

    out = []
    for _ in range(each):
        c = card()
        for kind, lead, x in (
            ("phone", rng.choice(["", "call", "tel", "phone"]), f"+{rng.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}"),
            ("phone", rng.choice(["call", "tel", "phone", "fax"]), f"({d(3)}) {d(3)}-{d(4)}"),
            ("phone", rng.choice(["call", "tel", "phone"]), f"{d(3)}-{d(3)}-{d(4)}"),
            ("phone", rng.choice(["call", "mobile", "phone"]), f"+{rng.randint(1, 99)} {d(3)} {d(3)} {d(3)}"),
            ("email", rng.choice(["", "mail", "contact"]), f"{w()}.{w()}@{w()}.{rng.choice(['com', 'org', 'net', 'de'])}"),
            ("email", rng.choice(["", "mail"]), f"{w()}{d(2)}@mail.{w()}.com"),
            ("ip", rng.choice(["", "host", "from", "ip"]), ".".join(str(rng.randint(0, 255)) for _ in range(4))),
            ("card", rng.choice(["", "card", "visa"]), c), ("card", "card", " ".join(c[k : k + 4] for k in range(0, 16, 4))),
            ("card", rng.choice(["", "card"]), "-".join(c[k : k + 4] for k in range(0, 16, 4))),
            ("phone", rng.choice(["tel", "call", "phone", "fax"]), f"0{rng.randint(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}"),
            (NONE, rng.choice(["on", "", "in"]), f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}"), (NONE, rng.choice(["version", "v", ""]), f"{d(1)}.{d(1)}.{d(2)}"),
            (NONE, rng.choice(["order", "invoice", "no", ""]), d(rng.randint(4, 10))), (NONE, rng.choice(["", "id", "ref"]), d(rng.choice([13, 16, 20, 24]))),
            (NONE, rng.choice(["price", ""]), f"{d(2)}.{d(2)}"), (NONE, rng.choice(["at", ""]), f"1{d(1)}:{d(2)}"), (NONE, "", f"{w()}{d(2)}"),
            (NONE, "", f"{d(1)} {d(2)} {d(3)}"), (NONE, "version", ".".join(d(3) for _ in range(4)).replace("0", "9")), (NONE, "", f"@{w()}{d(1)}"),
            (NONE, "isbn", f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}"), (NONE, "pages", f"{d(3)}-{d(3)}"), (NONE, rng.choice(["in", ""]), f"19{d(2)}-19{d(2)}"),
        ):
            if kind == NONE and luhn(only_digits(x) or "1") and len(only_digits(x)) in range(16, 20):
                continue
            text = f"{w()} {w()} {lead} {x} {w()} {w()}.".replace("  ", " ")
            a = text.index(f" {x} ") + 1
            out.append((text, [(kind, a, a + len(x))] if kind != NONE else []))
        # lists: several of one format in a row
        one = rng.choice([lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"+{rng.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}"])
        text, spans = f"{w()} {rng.choice(['phones', 'call', 'tel', 'numbers'])}", []
        for x in (one() for _ in range(rng.randint(2, 8))):
            spans.append(("phone", len(text) + 1, len(text) + 1 + len(x)))
            text += f" {x}"
        out.append((f"{text} {w()}.", spans))
        out.append((f"{w()} table {' '.join(d(rng.randint(1, 5)) for _ in range(rng.randint(5, 25)))} {w()}.", []))
    return out


PER_TEXT = 4  # islands of a labelled document that train, of at most WINDOW words each (a documented bound)


def _examples(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> list:
    return [(text, words[:WINDOW], spans) for text, spans in rows for _, words in zip(range(PER_TEXT), islands(text))]


def fit(docs: DataFrame) -> SemiMarkov:
    """Train on the default islands and on a bounded sample of ``docs`` (id, text)."""
    with_anchor = docs.where(F.col("text").rlike("[0-9@]")).select("id", "text")
    # only ids are ordered; at most TRAIN_DOCS of them meet the texts again
    picked = with_anchor.where("id is not null").select(F.col("id").alias("p_id")).distinct().orderBy(F.xxhash64("p_id"), "p_id").limit(TRAIN_DOCS)
    sample = with_anchor.join(F.broadcast(picked), F.col("id") == F.col("p_id"), "left_semi")
    # repeated rows of an id don't widen the sample
    sample = sample.groupBy("id").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only the islands travel to the driver, with their surroundings."""
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                for _, words in zip(range(PER_TEXT), islands(text)):
                    out.append(text[max(0, words[0][0] - 30) : words[:WINDOW][-1][1] + 5])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["text"])

    texts = sorted(r["text"] for r in sample.mapInArrow(cut, "text string").collect())
    rows = default_islands() + [(t, base_spans(t)) for t in texts]
    return train(_examples(rows))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base and spans (arrays of kind, start, end in code points).

    ``spans`` holds the base spans and what the field adds. Null and empty texts
    have none; rows with equal ids are read each for itself.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(fit(slim).weights)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(shared.value)
        for batch in batches:
            base, spans = [], []
            for text in batch.column("text").to_pylist():
                found = base_spans(text) if text and ANCHOR.search(text) else []
                more = model.find(text) if text and ANCHOR.search(text) else []
                more = [x for x in more if all(x[2] <= a or b <= x[1] for _, a, b in found)]
                by = lambda x: (KINDS.index(x[0]), x[1], x[2])
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(found, key=by)])
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(found + more, key=by)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, span), pa.array(spans, span)], names=["id", "base", "spans"])

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return slim.mapInArrow(scan, f"id long, base {kind}, spans {kind}").withColumnRenamed("id", id_col)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all spans; null texts are empty, an empty table gives no rows."""
    found = find_pii(table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))
