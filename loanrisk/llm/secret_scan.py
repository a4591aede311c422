"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least MIN_LENGTH key characters with a digit or several changes of case, or
a value of at least MIN_VALUE printable characters, of any length, that is given to a secret's name
(assigned, an argument of a call, the text of an element, the value of a flag) or stands for the
password in a URL: quoted text whole, other values up to white space, a quote or an angle bracket,
without closing punctuation. A name is the word before, however long, with a secret's name in it. Where a value of several parts (white space, /, =, ?, &, : between them)
holds such runs, these are the candidates, else the whole value is. The
forest sees its length, transitions between kinds of characters, share of characters that dictionary
words cover (the corpus's own words, counted over all documents, and a short list), characters that keys do not have, path-like surroundings and neighbouring words, and says how likely it is a secret. It is
trained from labelled findings: rows of features and a label. ``weak_labels`` takes those findings of
the corpus that a plain rule can settle (assigned to a secret's name; or a number, or named a digest),
``made_findings`` adds usual forms that a corpus may lack, made by rule.

Candidates of all documents are found in whole texts, words counted in whole texts of all documents. Only
the forest is fitted on a bounded sample: at most ``labelled_rows`` findings of either label, those of the
smallest hash. The dictionary is the DICTIONARY_WORDS words that most documents hold, if COMMON or more do.

Defined results: null and empty texts have no candidates; repeated rows have theirs each; overlapping
candidates do not occur; positions count characters from 0, the end excluded; an empty table gives an
empty table. Columns besides doc_id and text are not read; ``redact`` returns all columns as they are
but for the text and a whole-number n_chars.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import arrow_pass, checkpointed, map_texts, positional

MIN_LENGTH, MIN_VALUE, CONTEXT = 16, 6, 48
LABELLED_ROWS = 3000
REPLACEMENT = "[SECRET]"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{%d,}={0,2}" % MIN_LENGTH)
DIGIT = re.compile("[0-9]")
CASE_CHANGE = re.compile("[a-z](?=[A-Z])|[A-Z](?=[a-z])")
WORDS = re.compile(r"[^\W\d_]+")
NOT_OF_KEYS = re.compile(r"[^A-Za-z0-9+/_\-=]")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "glpat-", "sk-", "sk_", "pk_", "xox", "AIza", "eyJ")
SECRET_NAMES = frozenset(
    "token secret password passwd passphrase passcode pass pwd key apikey auth authorization bearer credential "
    "credentials private access clave contraseña schlüssel passwort kennwort jeton motdepasse пароль 密码".split()
)
NAMED = re.compile("|".join(sorted(SECRET_NAMES, key=lambda name: (-len(name), name))), re.IGNORECASE)
CAMEL = re.compile("(?<=[a-z])(?=[A-Z])")
# Signs after a name, and flags with their blanks; a value follows.
SIGN = re.compile(r"[:=(>]|(?<!\S)-{1,2}(?P<flag>\w[\w\-]*+)[ \t]++(?!-)")
ASSIGNED = re.compile(
    r"(?::=|=>|==?|:)[ \t]*(?:(?:bearer|basic|token)[ \t]+)?"
    r"(?:\"(?P<double>[^\"\r\n]{%d,})\"|'(?P<single>[^'\r\n]{%d,})'|`(?P<back>[^`\r\n]{%d,})`"
    r"|(?P<bare>[^\s\"'`<>]{%d,}))" % ((MIN_VALUE,) * 4),
    re.IGNORECASE,
)
# Right after the sign: quoted arguments, texts of elements, values of flags.
ARGUMENT = re.compile(
    r"[ \t]*(?:\"(?P<double>[^\"\r\n]{%d,})\"|'(?P<single>[^'\r\n]{%d,})'|`(?P<back>[^`\r\n]{%d,})`)" % ((MIN_VALUE,) * 3)
)
ELEMENT = re.compile(r"(?P<bare>[^\s\"'`<>]{%d,})(?=</)" % MIN_VALUE)
FLAG_VALUE = re.compile(ARGUMENT.pattern + r"|(?P<bare>[^\s\"'`<>]{%d,})" % MIN_VALUE)
IN_URL = re.compile(r"://[^\s/:@\"'<>]*:(?P<bare>[^\s/\"'<>]{%d,})@" % MIN_VALUE)
PARTS = re.compile(r"[\s/=?&:]")
HARMLESS_NAMES = frozenset(
    "sha md5 commit hash checksum digest uuid guid id revision version build serial etag example sample "
    "test card number phone order invoice isbn iban account reference".split()
)
# A corpus's words are dictionary words if they stand alone, not next to characters of keys.
DICTIONARY_WORDS, COMMON, LEAST_LETTERS, MOST_LETTERS = 20_000, 3, 4, 16
ALONE = r"(?<![\p{L}\p{N}+/_=\-])\p{Lu}?\p{Ll}{%d,%d}(?![\p{L}\p{N}+/_=\-])" % (LEAST_LETTERS - 1, MOST_LETTERS)
# Common in names and paths; they are dictionary words in any corpus.
DICTIONARY = (
    "about account after also application array before build cache check class client code common config "
    "content controller core count create data date default delete directory document download element "
    "error event example export field file filter first folder form from function group handler have header "
    "home html http image import index info input instance integer internal item java lang language last "
    "library line list load local main manager message method model module name network node number object "
    "order output package page param parent path point process profile program project property public "
    "python query record release report request resource response result return root sample script search "
    "section select server service session setting shared site size source spark start state static status "
    "stream string style system table target task template test text that their there they this time title "
    "type unit update upload user util utils value version view warehouse when where which window with work "
    "would your"
).split()
LISTED = frozenset(DICTIONARY)
FEATURES = (
    "log_length", "transitions", "digits", "upper", "hex", "entropy", "distinct", "longest_run", "dictionary",
    "vowels", "separators", "path", "secret_name", "harmless_name", "assigned", "quoted", "prefix", "longest_same",
    "not_of_keys", "spaces", "in_url", "cased",
)


def _runs(text: str) -> Iterator[tuple[int, int]]:
    for match in CANDIDATE.finditer(text):
        found = match.group()
        if DIGIT.search(found) or len(CASE_CHANGE.findall(found)) >= 4:
            yield match.span()


def _name_before(text: str, at: int, first: int) -> tuple[int, int]:
    """Place of the word before ``at``, not before ``first``: a closing quote or two and blanks may follow it."""
    while at > first and text[at - 1] in " \t":
        at -= 1
    for _ in range(2):
        if at > first and text[at - 1] in "\"'`])":
            at -= 1
    start = at
    while start > first and (text[start - 1].isalnum() or text[start - 1] == "_"):
        start -= 1
    return start, at


def _value_at(text: str, sign: re.Match, first: int) -> re.Match | None:
    """The value that a secret's name before this sign, or in this flag, is given."""
    at, kind = sign.span()[0], sign.group()
    if sign.lastgroup:
        return FLAG_VALUE.match(text, sign.end()) if NAMED.search(sign["flag"]) else None
    start, end = _name_before(text, at, first)
    if not NAMED.search(text, start, end):
        return None
    if kind == "(":
        return ARGUMENT.match(text, at + 1)
    if kind == ">":  # also the second half of an arrow, which its first half has seen
        return ELEMENT.match(text, at + 1) if text[start - 1 : start] == "<" else None
    return ASSIGNED.match(text, at)


def _values(text: str) -> Iterator[tuple[int, int]]:
    """Values given to a secret's name and passwords of URLs, in order, without overlaps."""
    spans = [(*match.span("bare"), False) for match in IN_URL.finditer(text)]
    reached = 0
    for sign in SIGN.finditer(text):
        if sign.start() < reached:
            continue
        match = _value_at(text, sign, reached)
        if match:
            start, reached = match.span(match.lastgroup)
            end = reached
            if match.lastgroup == "bare":
                end = start + len(text[start:end].rstrip(".,;:)]}"))
            if end - start >= MIN_VALUE:
                spans.append((start, end, True))
    reached = 0
    urls = sorted(span[:2] for span in spans if not span[2])
    for start, end, assigned in sorted(spans):
        inside = bisect_left(urls, (start, start)) if assigned else len(urls)
        if inside < len(urls) and urls[inside][1] <= end:
            continue  # the password inside is a candidate of its own
        if start >= reached:
            yield start, end
            reached = end


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Places of candidates in order, without overlaps."""
    runs = list(_runs(text))
    spans, at = [], 0
    for start, end in _values(text):
        while at < len(runs) and runs[at][1] <= start:
            spans.append(runs[at])
            at += 1
        held = []
        while at < len(runs) and runs[at][0] < end:
            held.append(runs[at])
            at += 1
        outside = any(first < start or last > end for first, last in held)
        if held and (outside or PARTS.search(text, start, end)):
            spans += held
        else:
            spans.append((start, end))
    yield from spans
    yield from runs[at:]


def _kind(letter: str) -> int:
    return 0 if letter.islower() else 1 if letter.isupper() else 2 if letter.isdigit() else 3


def corpus_words(docs: DataFrame, most: int = DICTIONARY_WORDS, common: int = COMMON) -> frozenset[str]:
    """The dictionary: words that the most documents hold, ties in alphabetical order, and the listed ones.

    All documents are counted whole, each word once a document; at most ``most`` words come to the driver.
    """
    held = F.array_distinct(F.transform(
        F.regexp_extract_all(docs["text"].cast("string"), F.lit(ALONE), F.lit(0)), F.lower
    ))
    counted = (
        docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("documents"))
        .filter((F.col("documents") >= common) & F.char_length("word").between(LEAST_LETTERS, MOST_LETTERS))
    )
    chosen = counted.orderBy(F.desc("documents"), "word").limit(most).select("word").toArrow()
    return LISTED.union(chosen.column(0).to_pylist())


def covered(low: str, words: frozenset[str]) -> int:
    """Characters that words cover, from the left, the longest word first."""
    total = at = 0
    last = len(low) - LEAST_LETTERS
    while at <= last:
        for end in range(min(at + MOST_LETTERS, len(low)), at + LEAST_LETTERS - 1, -1):
            if low[at:end] in words:
                total += end - at
                at = end
                break
        else:
            at += 1
    return total


def features(before: str, found: str, after: str, words: frozenset[str] = LISTED) -> list[float]:
    """What the forest sees of a candidate and the characters around it."""
    n = len(found)
    kinds = [_kind(letter) for letter in found]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    counts = Counter(found)
    longest = run = same = same_run = 1
    for k in range(1, n):
        run = run + 1 if kinds[k] == kinds[k - 1] else 1
        same_run = same_run + 1 if found[k] == found[k - 1] else 1
        longest, same = max(longest, run), max(same, same_run)
    low = found.lower()
    letters = sum(letter.isalpha() for letter in low) or 1
    near = WORDS.findall(CAMEL.sub(" ", before[-32:]).lower())[-3:]
    close = before.rstrip().rstrip("\"'`")
    return [
        math.log2(n), changes / (n - 1), kinds.count(2) / n, kinds.count(1) / n,
        float(all(letter in "0123456789abcdef" for letter in low)),
        -sum(c / n * math.log2(c / n) for c in counts.values()), len(counts) / n, longest / n,
        covered(low, words) / n, sum(letter in "aeiou" for letter in low) / letters,
        sum(letter in "/_-" for letter in found) / n,
        float(found.count("/") > 1 or before[-1:] in tuple("/\\.@") or after[:1] in tuple("@.\\") and after[1:2].isalnum()),
        float(any(word in SECRET_NAMES for word in near)), float(any(word in HARMLESS_NAMES for word in near)),
        float(close.rstrip()[-1:] in tuple("=:")), float(before[-1:] in tuple("\"'`") and after[:1] in tuple("\"'`")),
        float(found.startswith(PREFIXES)), same / n,
        len(NOT_OF_KEYS.findall(found)) / n, sum(letter.isspace() for letter in found) / n,
        float(after[:1] == "@" and "://" in before), float(0 < kinds.count(1) and 0 < kinds.count(0)),
    ]


@dataclass
class Forest:
    """Trees as arrays: a node's feature (-1: leaf), threshold, children and share of secrets."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values))
        rows = np.arange(len(values))
        for feature, threshold, left, right, share in zip(
            self.feature, self.threshold, self.left, self.right, self.share
        ):
            node = np.zeros(len(values), dtype=np.int64)
            while True:
                split = feature[node]
                inner = split >= 0
                if not inner.any():
                    break
                lower = values[rows, np.maximum(split, 0)] <= threshold[node]
                node = np.where(inner, np.where(lower, left[node], right[node]), node)
            total += share[node]
        return total / max(len(self.feature), 1)


def grow_forest(values: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 8, seed: int = 11) -> Forest:
    """Trees on bootstrap samples, each node split by the best of a random choice of features."""
    chance = np.random.default_rng(seed)
    size = 1 << (depth + 1)
    shape = (trees, size)
    forest = Forest(
        np.full(shape, -1), np.zeros(shape), np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape)
    )
    if not len(labels):
        return forest
    tried = max(1, int(math.sqrt(values.shape[1])))
    for tree in range(trees):
        rows = chance.integers(0, len(labels), len(labels))
        used = 1
        waiting = [(0, rows, 0)]
        while waiting:
            node, rows, level = waiting.pop()
            y = labels[rows]
            forest.share[tree, node] = y.mean()
            if level == depth or len(rows) < 4 or y.min() == y.max():
                continue
            best = None
            for k in chance.choice(values.shape[1], tried, replace=False):
                column = values[rows, k]
                cuts = np.unique(np.quantile(column, np.arange(1, 16) / 16))
                below = column[:, None] <= cuts
                n_low = below.sum(axis=0)
                ones = (below & (y[:, None] > 0)).sum(axis=0)
                n_high, ones_high = len(rows) - n_low, y.sum() - ones
                ok = (n_low > 0) & (n_high > 0)
                if not ok.any():
                    continue
                impurity = ones * (n_low - ones) / np.maximum(n_low, 1) + ones_high * (n_high - ones_high) / np.maximum(n_high, 1)
                at = int(np.argmin(np.where(ok, impurity, np.inf)))
                if best is None or impurity[at] < best[0]:
                    best = impurity[at], k, cuts[at]
            if best is None:
                continue
            _, k, cut = best
            low = values[rows, k] <= cut
            forest.feature[tree, node], forest.threshold[tree, node] = k, cut
            forest.left[tree, node], forest.right[tree, node] = used, used + 1
            waiting += [(used, rows[low], level + 1), (used + 1, rows[~low], level + 1)]
            used += 2
    return forest


def made_findings(
    each: int = 40, seed: int = 5, words: frozenset[str] = LISTED
) -> list[tuple[list[float], int]]:
    """Usual secrets and usual false alarms, made by rule: features and label."""
    chance = random.Random(seed)
    hexes, key = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"

    def drawn(alphabet: str, low: int, high: int) -> str:
        return "".join(chance.choice(alphabet) for _ in range(chance.randint(low, high)))

    def named(words: int) -> str:
        return "".join(chance.choice(("", "_", "-", "/"))[:1] + chance.choice(DICTIONARY) for _ in range(words))

    names = sorted(SECRET_NAMES)
    harmless = sorted(HARMLESS_NAMES)
    small, large = hexes[10:] + "ghijklmnopqrstuvwxyz", key[:26]
    marks = "!.$@~#%^&*?-_+"

    def password() -> str:
        """Mixed kinds of characters, with or without a word."""
        word = chance.choice(DICTIONARY).title() if chance.random() < 0.5 else drawn(key[:52], 3, 6)
        parts = [word, drawn(hexes[:10], 1, 4), drawn(marks, 1, 2), drawn(key[:62], 1, 5)]
        return "".join(parts if chance.random() < 0.5 else chance.sample(parts, 4))

    def prose(words: int) -> str:
        return " ".join(drawn(small, 2, 9) if chance.random() < 0.5 else chance.choice(DICTIONARY) for _ in range(words))

    found = []
    for _ in range(each):
        name, other = chance.choice(names), chance.choice(harmless)
        rows = [
            (f'{name} = "', drawn(hexes, 32, 64), '"', 1), (f'api_{name}: "', drawn(key, 20, 44), '"', 1),
            (f"{name.upper()}=", drawn(key, 20, 64), "\n", 1), ("", "AKIA" + drawn(key[:26] + key[52:62], 16, 16), " ", 1),
            ("use ", "ghp_" + drawn(key[:62], 36, 36), " to", 1), (f"Bearer ", "eyJ" + drawn(key, 40, 90), " ", 1),
            (f'{name} = "', drawn(hexes, 32, 64).upper(), '"!!', 1),
            (f"{other} ", drawn(hexes, 40, 40), " ", 0), (f"{other}: ", drawn(hexes, 32, 64), "\n", 0),
            ("the ", drawn(hexes[:10], 16, 20), " of", 0), (f"{name} ", drawn(hexes[:10], 16, 19), " ", 0),
            ("/usr/", named(4) + str(chance.randint(1, 99)), "/bin", 0), (f'{name} = "', named(4) + "1", '"', 0),
            (f"{other} ", "-".join(drawn(hexes, n, n) for n in (8, 4, 4, 4, 12)), " ", 0),
            (f'{name} = "', chance.choice("x0") * chance.randint(16, 40) + "1", '"', 0),
            (f"{name}: ", f"your_{name.encode('ascii', 'ignore').decode()}_example_value_here1", " ", 0),
            ("see ", named(5).title().replace("_", "") + "2", ".html", 0), ("https://example.com/", named(3) + drawn(hexes, 8, 16), "/", 0),
            (f'{name} = "', password(), '"', 1), (f"{name}: ", password(), "\n", 1), (f"{name}=", drawn(key[:62], 8, 15), " ", 1),
            (f'{name} = "', drawn(large, 16, 32), '"', 1), (f"{name.upper()}=", drawn(large, 16, 32), "\n", 1),
            (f'{name} = "', ".".join(drawn(key[:62], 3, 12) for _ in range(3)), '"', 1),
            (f'{name} = "', "".join(drawn(key[:62], 2, 8) + chance.choice(marks) for _ in range(4)), '"', 1),
            (f"postgres://{drawn(small, 3, 8)}:", password(), "@db.example.com", 1),
            (f"https://{drawn(small, 3, 8)}:", drawn(key[:62], 6, 20), "@host/path", 1),
            (f"{name}: ", drawn(small, 6, 12), " and", 0), (f"{name}: ", chance.choice(DICTIONARY).title() + drawn(small, 2, 4), " ", 0),
            (f'{name} = "', prose(chance.randint(2, 9)), '"', 0), (f'{name}: "', prose(4).capitalize() + ".", '"', 0),
            (f"{name} = ", f"get_{chance.choice(DICTIONARY)}()", "\n", 0), (f"{name}=", f"${{{chance.choice(DICTIONARY).upper()}}}", "\n", 0),
            (f"{name} = ", f"{chance.choice(DICTIONARY)}.{chance.choice(DICTIONARY)}", "\n", 0), (f'{name} = "', "*" * chance.randint(6, 16), '"', 0),
            (f'{name} = "', chance.choice(("changeme", "password", "your-password", "undefined", "required")), '"', 0),
            (f"<{name}>", password(), f"</{name}>", 1), (f"run --{name} ", password(), "\n", 1),
            (f"set{name.title()}('", password(), "')", 1), (f"--{name}=", drawn(key[:62], 8, 15), " ", 1),
            (f"<{name}>", chance.choice(DICTIONARY) + drawn(small, 2, 4), f"</{name}>", 0),
            (f"run --{name} ", drawn(small, 6, 12), " ", 0), (f'get_{name}("', named(2), '")', 0),
            (f"get{name.title()}('", drawn(small, 6, 12), "')", 0),
            ("http://user:", chance.choice(("password", "${PASSWORD}", "your_password", "******")), "@host", 0),
        ]
        found += [(features(before, text, after, words), label) for before, text, after, label in rows]
    return found


def findings(docs: DataFrame, words: frozenset[str] = LISTED) -> DataFrame:
    """One row per candidate: doc_id, start, end, secret_sha256, features."""
    known = docs.sparkSession.sparkContext.broadcast(words)  # at most DICTIONARY_WORDS and the list
    struct = T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("secret_sha256", T.StringType()), T.StructField("features", T.ArrayType(T.DoubleType())),
    ])

    def scan(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        offsets, starts, ends, digests, values = [0], [], [], [], []
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            for start, end in candidates(text):
                starts.append(start)
                ends.append(end)
                digests.append(hashlib.sha256(text[start:end].encode()).hexdigest())
                values.append(features(
                    text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT], known.value
                ))
            offsets.append(len(starts))
        rows = pa.StructArray.from_arrays(
            [pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(digests, pa.string()),
             pa.array(values, pa.list_(pa.float64()))],
            names=struct.names,
        )
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)]

    found = map_texts(
        docs, [docs["doc_id"]], docs["text"], scan, [T.StructField("found", T.ArrayType(struct))]
    )
    return found.select("doc_id", F.explode("found").alias("found")).select("doc_id", "found.*")


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings that a rule settles, with a label: 1 if assigned to a secret's name or of a known form
    and of high entropy; 0 if a number, or named harmless and not a secret."""
    value = {name: F.element_at("features", k + 1) for k, name in enumerate(FEATURES)}
    secret = (value["secret_name"] == 1) & (value["assigned"] == 1) | (value["prefix"] == 1)
    random_looking = (value["entropy"] >= 3) & (value["digits"] < 1) & (value["dictionary"] < 0.2) & (value["longest_same"] < 0.3)
    harmless = (value["digits"] == 1) | (value["harmless_name"] == 1) & (value["secret_name"] == 0) & (value["prefix"] == 0)
    # Only runs of key characters are settled as secrets; other values are left to the made findings.
    random_looking &= (value["not_of_keys"] == 0) & (value["log_length"] >= math.log2(MIN_LENGTH)) & (
        (value["digits"] > 0) | (value["transitions"] >= 0.2)
    )
    return found.select(
        "features", F.when(secret & random_looking, 1).when(harmless, 0).alias("label"), "secret_sha256"
    ).filter("label is not null")


def train(
    labelled: DataFrame, labelled_rows: int = LABELLED_ROWS, made: int = 40, words: frozenset[str] = LISTED
) -> Forest:
    """A forest from at most labelled_rows findings (features, label, secret_sha256) of either label;
    ``words``: the dictionary that the features were made with."""
    first = Window.partitionBy("label").orderBy("order", "features")
    rows = (
        labelled.select("features", "label", F.xxhash64("secret_sha256", "features").alias("order"))
        .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= labelled_rows)
        .orderBy("label", "place").select("features", "label").toArrow()
    )
    known = made_findings(made, words=words)
    values = [*rows.column("features").to_pylist(), *(x for x, _ in known)]
    labels = [*rows.column("label").to_pylist(), *(y for _, y in known)]
    return grow_forest(np.array(values, dtype=float).reshape(-1, len(FEATURES)), np.array(labels, dtype=int))


def secret_scan(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, start, end, secret_sha256, score, is_secret."""
    words = corpus_words(docs)
    found = checkpointed(findings(docs, words))
    shared = docs.sparkSession.sparkContext.broadcast(train(weak_labels(found), words=words))  # of a fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            values = batch.columns[-1].flatten().to_numpy().reshape(-1, len(FEATURES))
            yield [*batch.columns[:-1], pa.array(shared.value.scores(values))]

    schema = T.StructType([*found.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    return arrow_pass(found, judge, schema).withColumn("is_secret", F.col("score") >= least_score)


def redact(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """docs with every secret replaced in its text, and n_chars counted again where a text changed."""
    plain, names = positional(docs)
    text, n_chars = names["text"], names.get("n_chars")
    words = corpus_words(docs)
    forest = train(weak_labels(checkpointed(findings(docs, words))), words=words)
    shared = docs.sparkSession.sparkContext.broadcast((forest, words))  # both of a bounded size

    def replace(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        decoded = [raw.decode("utf-8", "replace") for raw in texts]
        forest, words = shared.value
        spans, values = [], []
        for k, one in enumerate(decoded):
            for start, end in candidates(one):
                spans.append((k, start, end))
                values.append(features(
                    one[max(0, start - CONTEXT) : start], one[start:end], one[end : end + CONTEXT], words
                ))
        scores = forest.scores(np.array(values, dtype=float).reshape(-1, len(FEATURES)))
        kept: dict[int, list[str]] = {}
        reached: dict[int, int] = {}
        for (k, start, end), score in zip(spans, scores):
            if score >= least_score:
                kept.setdefault(k, []).append(decoded[k][reached.get(k, 0) : start])
                reached[k] = end
        changed = [
            REPLACEMENT.join([*kept[k], one[reached[k] :]]) if k in kept else None for k, one in enumerate(decoded)
        ]
        return [pa.array(changed, pa.string())]

    scanned = map_texts(
        plain, [plain[name] for name in plain.columns], plain[text], replace, [T.StructField("clean", T.StringType())]
    )
    columns = []
    for name, given in zip(plain.columns, plain.schema.fields):
        column = F.col(name)
        if name == text:
            column = F.coalesce("clean", text)
        elif name == n_chars and isinstance(given.dataType, (T.IntegerType, T.LongType)):
            column = F.when(F.col("clean").isNotNull(), F.char_length("clean").cast(given.dataType)).otherwise(column)
        columns.append(column.alias(name))
    return scanned.select(*columns).toDF(*docs.columns)
