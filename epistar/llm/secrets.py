"""Secret scans: candidate runs, judged by a random forest that removes false positives.

A candidate is a run of at least ``MIN_LENGTH`` key characters that looks
unlike a word: it mixes letters and digits, mixes cases inside, or is a long
run of capitals or digits. So is the whole value after a name with a
credential word in it and ``=`` or ``:``, of any length and any signs but blanks
(quoted: any signs), without its quotes and the marks that end a clause. The scan over the texts finds candidates with
their surroundings, turns each into numbers (length, character transitions,
dictionary coverage, path signs, neighbouring words) and lets the forest score
it.

The forest is Spark ML's, trained on labelled findings: a DataFrame of
(before, candidate, after, label). ``default_findings`` makes such a set, by
seed, from the written formats of keys and of their usual look-alikes; a
caller with reviewed findings passes those. At most ``MAX_FINDINGS`` rows train
(a documented bound on the model's sample, taken in hash order); scanning covers
every text whole. The trained trees travel to the tasks as small arrays, so a
scan is one pass without a shuffle.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, table

MIN_LENGTH = 12
CONTEXT = 40
MAX_FINDINGS = 20_000
TREES = 25
DEPTH = 8
CUTOFF = 0.5
MASK = "[SECRET]"

RUN = re.compile(r"[A-Za-z0-9+/_\-]{12,}={0,2}")
NAMED = re.compile(r"""(?<![A-Za-z0-9_\-])([A-Za-z0-9_\-]++)["']?[ \t]*(?:=>|:=|[=:])[ \t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"']\S*))""")
# Words of ordinary identifiers, signs of a checksum or an id.
PLAIN_WORDS = (
    "commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "uuid", "guid", "id", "build", "version", "revision", "etag", "order", "invoice",
    "isbn", "phone", "card", "image", "asset", "file", "path", "page", "ref",
)
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk_live_", "sk_test_", "rk_test_", "sk-", "xox", "AIza", "eyJ")
DICTIONARY = (
    "access", "account", "admin", "api", "app", "asset", "auth", "base", "build", "cache", "class", "client", "code", "common", "config", "content", "core",
    "data", "date", "default", "dev", "doc", "example", "factory", "file", "get", "home", "html", "http", "image", "index", "info", "item", "lib", "linux",
    "list", "load", "local", "log", "main", "manager", "message", "model", "module", "name", "node", "number", "page", "path", "post", "process", "product",
    "project", "public", "request", "resource", "response", "result", "review", "score", "script", "server", "service", "session", "set", "site", "source",
    "src", "static", "string", "style", "system", "table", "test", "text", "time", "type", "update", "user", "util", "value", "version", "view", "web", "with",
)
FEATURES = (
    "length", "digits", "upper", "lower", "other", "digit_letter", "case_change", "same_class", "entropy", "hex", "coverage", "longest_letters",
    "vowels", "slashes", "dashes", "prefix_capitals", "after_equals", "after_quote", "url_before", "path_before", "key_word", "key_near", "plain_word", "dotted", "known_prefix", "signs", "brackets",
)


# Last words of a credential's name, and those that are one after a word of the second list.
KEY_PARTS = ("password", "passwords", "passwd", "pwd", "passphrase", "secret", "secrets", "token", "tokens", "apikey", "auth", "bearer", "credential", "credentials")
KEY_TAILS, KEY_HEADS = ("key", "keys", "value", "string", "hash"), ("api", "access", "private", "secret", "auth", "token", "password", "client")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
# the password of an address (scheme://user:password@host) and of a command line's user option
IN_ADDRESS = re.compile(r"""[A-Za-z][A-Za-z0-9+.\-]{1,20}://[^\s:/@"']{0,200}:([^\s@"'/]{1,200})@""")
USER_OPTION = re.compile(r"""(?<!\S)(?:-u|--user)[ =]["']?[^\s:"']{1,200}:([^\s"']{1,200})""")


def names_credential(name: str) -> bool:
    """Whether a name's last part, or the last two, announce a credential ("db_password", "apiKey", not "secretary")."""
    parts = [p.lower() for p in PART.findall(name) if not p.isdigit()]
    if not parts:
        return False
    return parts[-1] in KEY_PARTS or (parts[-1] in KEY_TAILS and len(parts) > 1 and parts[-2] in KEY_HEADS)


def named_values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the values that stand after the name of a credential or in its place in an address."""
    for pattern in (IN_ADDRESS, USER_OPTION):
        yield from (m.span(1) for m in pattern.finditer(text))
    for m in NAMED.finditer(text):
        if names_credential(m.group(1)):
            k = m.lastindex
            a, b = m.span(k)
            if k == 4:
                value = re.split(r"&(?=[A-Za-z0-9_\-]+=)", m.group(k))[0].rstrip(".,;:)]}>\"'")
                b = a + len(value)
            if b > a:
                yield a, b


def is_candidate(x: str) -> bool:
    letters = sum(c.isalpha() for c in x)
    digits = sum(c.isdigit() for c in x)
    if letters and digits:
        return True
    if digits >= MIN_LENGTH or (letters >= 16 and x.upper() == x):
        return True
    return letters >= 16 and len(re.findall(r"[a-z][A-Z]", x)) >= 2


def features(before: str, x: str, after: str) -> list[float]:
    """The numbers of one candidate, in the order of ``FEATURES``."""
    n = len(x)
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in x]
    counts = {c: x.count(c) for c in set(x)}
    pairs = list(zip(kind, kind[1:])) or [("o", "o")]
    low, near = x.lower(), before.lower()
    covered = np.zeros(n, dtype=bool)
    for w in DICTIONARY:
        at = low.find(w)
        while at >= 0:
            covered[at : at + len(w)] = True
            at = low.find(w, at + 1)
    words = re.findall(r"[a-z_\-0-9]+", near)
    lead = near.rstrip(" \"'")
    return [
        float(min(n, 200)), kind.count("d") / n, kind.count("u") / n, kind.count("l") / n, kind.count("o") / n,
        sum({a, b} in ({"d", "l"}, {"d", "u"}) for a, b in pairs) / len(pairs), sum({a, b} == {"l", "u"} for a, b in pairs) / len(pairs),
        sum(a == b for a, b in pairs) / len(pairs), -sum(k / n * math.log2(k / n) for k in counts.values()),
        float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", x))), float(covered.mean()), float(max(map(len, re.findall(r"[A-Za-z]+", x)), default=0)),
        sum(c in "aeiou" for c in low) / n, float(x.count("/")), float(x.count("-") + x.count("_")),
        float(bool(re.match(r"[A-Z]{3,}", x))), float(lead[-1:] in ("=", ":")), float(before[-1:] in ("\"", "'")), float("://" in near[-30:]),
        float(bool(re.search(r"[/.\\]$", before))), float(bool(words) and names_credential(words[-1])),
        float(any(names_credential(w) for w in words[-4:])), float(any(w in PLAIN_WORDS for w in words[-2:])), float(after[:1] == "."), float(x.startswith(PREFIXES)),
        float(sum(c in "!@#$%^&*?~+" for c in x)), float(sum(c in "()<>{}[]." for c in x)),
    ]


def default_findings(seed: int = 11, each: int = 150) -> list[tuple[str, str, str, int]]:
    """Labelled findings by format: keys and passwords (1), and what merely looks like them (0)."""
    rng = random.Random(seed)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    hexa, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    prose = lambda: " ".join(pick("aeinorst", rng.randint(2, 8)) for _ in range(rng.randint(2, 5))) + " "
    spoilt = lambda x: "".join({"a": "@", "o": "0", "e": "3", "i": "1", "s": "$"}.get(c, c) if rng.random() < 0.5 else c for c in x)
    signed_word = lambda: "".join(c + (pick("!@#$%^&*?", 1) if k in (1, 4, 6) and rng.random() < 0.7 else "") for k, c in enumerate(pick("abcdefghijklmnopqrstuvwxyz", rng.randint(5, 12)) + pick("!@#$&", 1)))
    out = []
    for _ in range(each):
        word = lambda: rng.choice(DICTIONARY)
        key = rng.choice((*KEY_PARTS, "api_key", "api-key", "access_key", "private_key"))
        quote = rng.choice(["", "\"", "'"])
        sign = rng.choice(["=", " = ", ": ", "="])
        made_up = lambda: spoilt(word().title() + rng.choice(["", word(), word().title()])) + rng.choice(["", "!", "&", "#", "@", "-"]) + str(rng.randint(1, 9999))
        yes = [
            (prose(), "AKIA" + pick(caps, 16), " " + prose()),
            (prose(), rng.choice(["ghp_", "gho_"]) + pick(alnum, 36), " "),
            (prose(), rng.choice(["sk_live_", "sk-", "rk_test_"]) + pick(alnum, rng.randint(24, 40)), " "),
            (prose() + key + sign + quote, pick(hexa, rng.choice([16, 18, 24, 32, 40, 64])), quote + " "),
            (prose() + key + sign + quote, pick(alnum, rng.randint(12, 48)), quote + " "),
            (prose() + "authorization: bearer ", "eyJ" + pick(alnum, rng.randint(20, 60)), "."),
            (prose() + key.upper() + sign + quote, pick(alnum + "+/", 40), quote),
            (prose() + key + sign + quote, made_up(), quote + rng.choice(["", " ", ".", ", "]) + prose()),
            (prose() + key.upper() + sign + quote, pick(alnum + "!@#$%^&*?", rng.randint(6, 20)), quote + " "),
            (prose() + key + sign + quote, signed_word(), quote + rng.choice(["", " ", ".", ", "]) + prose()),
            (prose() + key + sign + quote, pick("abcdefghijklmnopqrstuvwxyz", rng.choice([16, 16, 20, 24])), quote + " "),
            (prose() + rng.choice(["postgres", "mysql", "https", "amqp", "redis"]) + f"://{word()}:", rng.choice([made_up, signed_word])(), f"@{word()}.{word()} "),
            (prose() + rng.choice(["curl -u ", "curl --user ", "wget --user="]) + word() + ":", rng.choice([made_up, signed_word])(), " " + prose()),
        ]
        syllables = "".join(rng.choice("STNRLDCHMP") + rng.choice("EAIOU") + rng.choice(["", "N", "R", "S", "CH"]) for _ in range(rng.randint(6, 14)))
        number = pick("0123456789", rng.randint(12, 19))
        no = [
            (prose() + rng.choice(["", "card ", "order ", "isbn ", "id "]), number, " "),
            (prose() + rng.choice(["commit ", "revision ", "sha1: ", "build "]), pick(hexa, 40), " "),
            (prose() + rng.choice(["md5 ", "checksum: ", "md5="]), pick(hexa, 32), " "),
            (prose() + rng.choice(["uuid ", "", "id="]), "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)), " "),
            (prose() + "/usr/" + word() + "/", f"{word()}/{word()}{rng.randint(1, 99)}/{word()}-{word()}", ".txt"),
            (prose() + "https://" + word() + ".example.com/", f"{word()}/{rng.randint(2000, 2030)}/{word()}-{word()}-{word()}", " "),
            (prose(), word() + "".join(word().title() for _ in range(rng.randint(1, 3))) + str(rng.randint(1, 20)), "("),
            (prose().upper(), syllables.ljust(16, "E"), rng.choice(["!! ", " ", ". "])),
            (prose(), word().title() + word().title() + word().title() + "Factory", " "),
            (prose(), f"{word()}_{word()}_{rng.randint(1, 999)}_{word()}", " "),
            (prose() + rng.choice(["on ", "at ", ""]), f"20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}", ":15"),
            (prose(), "-".join([word(), word(), pick("0123456789", 2), word()]), " "),
            (prose() + key + rng.choice([": ", "=", " = "]), rng.choice([word(), pick("aeinorst", rng.randint(1, 9)), "none", "null", "None", "true", "required"]), rng.choice([" ", ", ", ". "]) + prose()),
            (prose() + key + rng.choice([": ", "=", " = "]) + quote, rng.choice(["********", "xxxxxxxx", "<" + word() + ">", "${" + word().upper() + "}", "{{" + word() + "}}", word() + "_" + word(), word() + "." + word(), "%s"]), quote + " "),
            (prose() + key + rng.choice(["=", " = "]), rng.choice([f"get_{word()}()", f"{word()}.{word()}({word()})", f"os.environ[{word().upper()}]", f"self.{word()}"]), " "),
            (prose() + f"https://{word()}:", rng.choice(["********", "${" + word().upper() + "}", "<" + word() + ">", word()]), f"@{word()}.{word()} "),
            (prose() + rng.choice(["author: ", "author=", "authors: "]), rng.choice([word().title(), pick("aeinorst", 1).upper() + pick("aeinorst", rng.randint(2, 8))]), " " + prose()),
        ]
        out += [(*x, 1) for x in yes] + [(*x, 0) for x in no]
    return [(b[-CONTEXT:], x, a[:CONTEXT], y) for b, x, a, y in out]


class Forest:
    """Trained trees as arrays, with the forest's mean vote for label 1."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, cut, left, right, vote in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = np.where(rows[inner, feature[node]] <= cut[node], left[node], right[node])
            total += vote[at]
        return total / len(self.trees)


def _tree_arrays(tree) -> tuple[np.ndarray, ...]:
    feature, cut, left, right, vote = [], [], [], [], []

    def add(node) -> int:
        k = len(feature)
        for part, value in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (vote, 0.0)):
            part.append(value)
        if node.subtreeDepth() > 0:
            feature[k], cut[k] = node.split().featureIndex(), node.split().threshold()
            left[k], right[k] = add(node.leftChild()), add(node.rightChild())
        else:
            counts = list(node.impurityStats().stats())
            vote[k] = counts[1] / max(sum(counts), 1e-9)
        return k

    add(tree._call_java("rootNode"))
    return tuple(np.array(x) for x in (feature, cut, left, right, vote))


def train_forest(spark: SparkSession, findings: DataFrame | None = None, seed: int = 11) -> Forest:
    """Train on labelled findings (before, candidate, after, label); null fields count as empty, null labels are left out."""
    schema = "before string, candidate string, after string, label int"
    if findings is None:
        findings = spark.createDataFrame(default_findings(), schema)
    rows = (
        findings.where("label is not null and candidate is not null and candidate <> ''")
        .select("before", "candidate", "after", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("before", "candidate", "after", "label")).limit(MAX_FINDINGS).collect()
    )
    data = [(features(r["before"] or "", r["candidate"], r["after"] or ""), float(r["label"])) for r in rows]
    if len({y for _, y in data}) < 2:
        raise ValueError("labelled findings must hold both labels")
    frame = spark.createDataFrame(data, "f array<double>, label double").select(array_to_vector("f").alias("features"), "label")
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(frame)
    return Forest([_tree_arrays(t) for t in model.trees])


def find(text: str, forest: Forest) -> list[tuple[int, int, float]]:
    """(start, end, score) of the findings the forest keeps, in code points."""
    named = list(named_values(text))
    at = sorted({*named, *(m.span() for m in RUN.finditer(text) if is_candidate(m.group()))})
    if not at:
        return []
    scores = forest.score(np.array([features(text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT]) for a, b in at]))
    out: list[tuple[int, int, float]] = []
    for (a, b), s in zip(at, scores):
        if s < CUTOFF:
            continue
        if out and a < out[-1][1]:  # a run and the value it is part of are one finding
            out[-1] = out[-1][0], max(b, out[-1][1]), max(out[-1][2], float(s))
        else:
            out.append((a, b, float(s)))
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", findings: DataFrame | None = None) -> DataFrame:
    """(id, start, end, candidate, score) of every secret found; null and empty texts have none.

    Rows with equal ids are scanned each for itself.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train_forest(spark, findings).trees)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(shared.value)
        for batch in batches:
            rows = [
                (i, a, b, text[a:b], s)
                for i, text in enumerate(batch.column("text").to_pylist()) if text for a, b, s in find(text, forest)
            ]
            if rows:
                at, a, b, x, s = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(x), pa.array(s, pa.float64())],
                    names=["id", "start", "end", "candidate", "score"],
                )

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, "id long, start long, end long, candidate string, score double"
    )
    return found.select(F.col("id").alias(id_col), "start", "end", "candidate", "score")


def redact_secrets(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """``docs`` with each secret of ``text`` replaced by ``MASK`` and ``n_chars`` counted anew where it changed."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train_forest(spark, findings).trees)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(shared.value)
        for batch in batches:
            names = batch.schema.names
            texts, sizes = batch.column(names.index("text")).to_pylist(), None
            if "n_chars" in names:
                sizes = batch.column(names.index("n_chars")).to_pylist()
            for i, text in enumerate(texts):
                found = find(text, forest) if text else []
                for a, b, _ in reversed(found):
                    text = text[:a] + MASK + text[b:]
                if found:
                    texts[i] = text
                    if sizes is not None:
                        sizes[i] = len(text)
            columns = list(batch.columns)
            k = names.index("text")
            columns[k] = pa.array(texts, batch.schema.field(k).type)
            if sizes is not None:
                k = names.index("n_chars")
                columns[k] = pa.array(sizes, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(clean, docs.schema)


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The findings in ``documents`` that the forest keeps; null texts and an empty table have none."""
    return scan_secrets(table(spark, sf_dir, "documents"))
