"""SimHash components and winnowed fingerprints against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from loanrisk.llm import fingerprints, queries, simhash

MASK = (1 << 64) - 1


def plain_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_roots(prints, max_bits=4):
    """Components over all pairs: the least member of each."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def test_simhash_query(spark, scale_dir, documents, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    prints = {row["doc_id"]: plain_fingerprint(row["text"]) for row in documents.collect()}
    assert all(simhash.fingerprint((r["text"] or "").encode()) == signed(prints[r["doc_id"]]) for r in documents.collect())
    roots = plain_roots(prints.values())
    first = {}
    for doc_id, found in sorted(prints.items()):
        first.setdefault(roots[found], doc_id)
    expected = sorted((doc_id, f"{found:016x}", first[roots[found]]) for doc_id, found in prints.items())
    got = queries.op5_simhash_near_dedup(spark, scale_dir).collect()
    assert sorted(tuple(row) for row in got) == expected
    assert len({row["component_id"] for row in got}) < len(got)


def test_simhash_odd_texts(odd_documents, no_documents):
    given = odd_documents.collect()
    roots = plain_roots([plain_fingerprint(row["text"]) for row in given])
    first = defaultdict(list)
    for row in given:
        if row["doc_id"] is not None:
            first[roots[plain_fingerprint(row["text"])]].append(row["doc_id"])
    expected = Counter(
        (row["doc_id"], f"{plain_fingerprint(row['text']):016x}", min(first[roots[plain_fingerprint(row["text"])]], default=None))
        for row in given
    )
    assert Counter(tuple(row) for row in simhash.simhash_components(odd_documents).collect()) == expected
    kept = simhash.drop_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == len(set(roots.values()))
    assert simhash.simhash_components(no_documents).count() == 0
    assert simhash.drop_near_copies(no_documents).count() == 0


def crowd(seed: int) -> list[int]:
    """Fingerprints around a few centres, chains of them, and strangers."""
    chance = random.Random(seed)
    found = [chance.getrandbits(64) for _ in range(150)]
    for _ in range(3):
        centre = chance.getrandbits(64)
        found += [centre ^ sum(1 << b for b in chance.sample(range(64), chance.randint(0, 3))) for _ in range(300)]
    link = chance.getrandbits(64)
    for _ in range(60):
        link ^= sum(1 << b for b in chance.sample(range(64), chance.choice((1, 4, 4, 5))))
        found.append(link)
    return sorted(set(found))


@pytest.mark.parametrize("seed, layout", [
    (1, {}), (2, {"block": 16}), (3, {"segments": 5, "chosen": 2}), (5, {"max_bits": 3, "segments": 2}),
])
def test_links_join_what_all_pairs_join(spark, seed, layout):
    prints = crowd(seed)
    classes = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    edges = simhash.links(classes, **layout)
    for row in edges.collect():
        assert 0 < ((row["source"] ^ row["target"]) & MASK).bit_count()
    found = {row["node"] & MASK: row["root"] & MASK for row in simhash.components(edges).collect()}
    expected = plain_roots(prints, layout.get("max_bits", 4))
    groups = defaultdict(set)
    for p, root in expected.items():
        groups[root].add(p)
    got = defaultdict(set)
    for p in prints:
        got[found.get(p, p)].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_a_layout_that_would_miss_pairs_is_refused():
    for layout in ({"segments": 2}, {"segments": 3, "chosen": 2}, {"segments": 4, "chosen": 2}):
        with pytest.raises(ValueError):
            simhash.key_masks(**layout)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5000, 5000)], "source long, target long")
    roots = {row["node"]: row["root"] for row in simhash.components(edges).collect()}
    assert all(roots[k] == 0 for k in range(1, 201))
    assert all(roots[1000 + k] == 1000 for k in range(1, 300))


def plain_winnow(text: str | None, xxhash64, gram=4, window=8):
    """(hash, position) pairs; xxhash64 gives the engine's hash of a unit or of joined hashes."""
    units = re.findall(
        r"[一-鿿々〇぀-ゟ゠-ヿ]|[^\s一-鿿々〇぀-ゟ゠-ヿ]{1,64}",
        text or "", flags=re.ASCII,
    )
    hashes = [xxhash64(unit) for unit in units]

    def rotate(value, bits):
        return ((value << bits) | (value >> (64 - bits))) & MASK if bits else value

    if not hashes:
        return []
    if len(hashes) < gram:
        grams = [xxhash64(",".join(str(signed(h)) for h in hashes))]
    else:
        grams = []
        for k in range(len(hashes) - gram + 1):
            rolled = 0
            for place, h in enumerate(hashes[k : k + gram]):
                rolled ^= rotate(h, gram - 1 - place)
            grams.append(rolled)
    grams = [g >> 29 for g in grams]
    chosen = []
    for start in range(max(1, len(grams) - window + 1)):
        part = list(enumerate(grams))[start : start + window]
        least = min(g for _, g in part)
        pick = max(place for place, g in part if g == least)
        if (least, pick) not in chosen:
            chosen.append((least, pick))
    return chosen


def xxhash64(value: str) -> int:
    return xxh64_intdigest(value.encode(), 42)


def plain_spelled(text):
    return " ".join(f"{g:x}:{place}" for g, place in plain_winnow(text, xxhash64))


def plain_likeness(one, other):
    a = {g for g, _ in plain_winnow(one, xxhash64)}
    b = {g for g, _ in plain_winnow(other, xxhash64)}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def plain_comparison(rows):
    """Rows (doc_id, text) from the largest id down."""
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_spelled(text), plain_spelled(edited),
            pytest.approx(plain_likeness(text, edited)), pytest.approx(plain_likeness(text, following)),
        ))
    return out


def test_fingerprint_query(spark, scale_dir, documents):
    rows = sorted(((row["doc_id"], row["text"]) for row in documents.collect()), reverse=True)
    got = sorted((tuple(row) for row in queries.op10_document_fingerprints(spark, scale_dir).collect()), reverse=True)
    assert got == plain_comparison(rows)


@pytest.mark.parametrize("rows", [
    [(5, "only one text of a few words here")],
    [(1, None), (2, ""), (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (40, "é" * 7), (41, "a b")],
])
def test_fingerprints_of_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for buckets in (1, 2, 7):
        compared = fingerprints.with_next(docs, buckets)
        assert compared.filter("not guest").count() == len(rows)
    got = fingerprints.edited_likeness(docs).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256),
        fingerprints.spelled(F.col("chosen")), fingerprints.spelled(F.col("edited_chosen")), "near_edited", "near_next",
    )
    assert sorted((tuple(row) for row in got.collect()), reverse=True) == plain_comparison(sorted(rows, reverse=True, key=lambda r: r[0]))


def test_fingerprints_of_odd_documents(odd_documents, no_documents):
    got = fingerprints.edited_likeness(odd_documents).collect()
    assert len(got) == odd_documents.count()
    by_id = {row["doc_id"]: row for row in got}
    for row in fingerprints.fingerprints(odd_documents).collect():
        assert all(0 <= found["position"] and 0 <= found["hash"] for found in row["fingerprint"])
    assert by_id[0]["chosen"] == by_id[1]["chosen"] == by_id[2]["chosen"] == []
    assert by_id[12]["chosen"] == by_id[13]["chosen"]
    assert all(0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1 for row in got)
    assert fingerprints.edited_likeness(no_documents).count() == 0


def test_a_shared_passage_is_found(spark):
    """gram + window - 1 shared words share a chosen hash, wherever they stand."""
    chance = random.Random(4)
    passage = " ".join(f"shared{k}" for k in range(fingerprints.GRAM + fingerprints.WINDOW - 1))

    def noise():
        return " ".join(f"w{chance.random()}" for _ in range(chance.randint(0, 40)))

    docs = spark.createDataFrame([(k, f"{noise()} {passage} {noise()}") for k in range(60)], "doc_id long, text string")
    chosen = [{f["hash"] for f in row["fingerprint"]} for row in fingerprints.fingerprints(docs).collect()]
    assert all(a & b for a in chosen for b in chosen)


def test_no_python_in_the_fingerprint_plan(spark, scale_dir):
    plan = queries.op10_document_fingerprints(spark, scale_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("letters", ["กขคงจฉชซญดตถทธนบปผพฟมยรลวสหอะาิีุูเแโใไ", "ກຂຄງຈສຊຍດຕຖທນບປຜ", "កខគឃងចឆជឈញដឋឌ", "abcdefXYZ0123456789+/"])
def test_a_shifted_copy_in_an_unspaced_run_is_found(spark, letters):
    chance = random.Random(6)
    passage = "".join(chance.choice(letters) for _ in range(5000))
    docs = spark.createDataFrame([(1, passage), (2, letters[0] + passage), (3, f"{letters[:5] * 30}{passage[100:400]}{letters[-5:] * 30}")], "doc_id long, text string")
    one, shifted, part = ({f["hash"] for f in r["fingerprint"]} for r in fingerprints.fingerprints(docs).orderBy("doc_id").collect())
    assert len(one & shifted) >= 0.99 * len(one | shifted)
    assert len(one & part) >= 300 // (2 * fingerprints.WINDOW)


def test_units(spark):
    texts = ["x" * 64 + " " + "y" * 65, "ab\U00020000cd 漢ef\U0001f600g", "ไทย word"]
    units = [["x" * 64, *"y" * 65], ["ab", "\U00020000", "cd", "漢", "ef\U0001f600g"], [*"ไทย", "word"]]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = docs.select(F.regexp_extract_all("text", F.lit(fingerprints.UNIT), F.lit(0)))
    assert sorted(r[0] for r in found.collect()) == sorted(units)


#: What UNIT is to match, without the ranges that spare the look-up of scripts.
PLAIN_IN_RUN = rf"[^\s{fingerprints.SINGLE}" + "\U00020000]"
PLAIN_UNIT = rf"[{fingerprints.SINGLE}]|(?<!{PLAIN_IN_RUN}){PLAIN_IN_RUN}{{1,64}}+(?!{PLAIN_IN_RUN})|{PLAIN_IN_RUN}"


def units_by(pattern):
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))


def test_units_of_every_character(spark):
    """Each character in a word, at its ends, alone and in a run over 64."""
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF]
    chance = random.Random(8)
    some = [0x0, 0x20, 0x41, 0xDFF, 0xE00, 0xE01, 0xEFF, 0x1000, 0x1780, 0x1BFF, 0x1C00, 0x2E7F, 0x2E80, 0x3042, 0x4E00,
            0xABFF, 0xAC00, 0xD7A3, 0xD7A4, 0xF900, 0xFF66, 0x1F600, 0x20000, 0x10FFFF]
    texts = [" ".join(f"x{c}y {c} {c}y x{c}" for c in points[k : k + 4096]) for k in range(0, len(points), 4096)]
    texts += ["".join(chr(chance.choice(some)) * chance.choice((1, 1, 2, 64, 65)) for _ in range(60)) for _ in range(400)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert docs.filter(~units_by(fingerprints.UNIT).eqNullSafe(units_by(PLAIN_UNIT))).count() == 0


def test_units_take_no_script_look_up_per_character(spark):
    """Well under the time of the plain class; it was that class, and most of the operator's time."""
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda k: F.lower(F.hex(F.xxhash64(k, "id")))))
    docs = spark.range(300).select(text.alias("text")).localCheckpoint()
    taken = {}
    for pattern in (PLAIN_UNIT, fingerprints.UNIT):
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            docs.select(F.size(units_by(pattern)).alias("units")).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        taken[pattern] = min(runs)
    assert taken[fingerprints.UNIT] < 0.6 * taken[PLAIN_UNIT]
