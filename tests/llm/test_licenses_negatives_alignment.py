"""License scans, hard negatives and token alignment against brute force on small tables."""

import bisect
import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import hard_negatives, license_scan, token_alignment
from shelfcast.llm.license_rules import BASE, RULES, SPAN

DOCS = "doc_id long, text string, words string, start long, detections long, digest string"
TEXTS = [
    None, "", " \n\t ", "gnu", "Licensed under the Apache License, Version 2.0.", "MIT License / mit-license",
    "This work is licensed under the GNU General Public License, version 3 or any later; CC BY-NC-SA 4.0",
    "SPDX-License-Identifier: MIT", "https://opensource.org/licenses/Apache-2.0 apache license",
    "cc by cc by cc by", "Apache License apache license", "İ GNU general PUBLIC license ß",
    "mit der license und mit license", "word " * 3000 + "mit license " * 200,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MIT License", "MIT License",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "w", 1, 2, "d") for n, t in enumerate(TEXTS)]
    rows += [(None, TEXTS[4], "w", 1, 2, "d")] * 2 + [rows[5]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def folded(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]


def brute_matches(words):
    found = []
    for at, word in enumerate(words):
        before, after = words[max(0, at - SPAN): at], words[at: at + SPAN]
        text = " " + "".join(w + " " for w in before) + "<" + " ".join(after) + " "
        for r in RULES:
            if r.gate == word and (hit := re.search(f" {r.pattern} ", text)):
                start = at - (hit.group().split("<")[0].count(" ") - 1)
                found.append((start, start + hit.group().count(" ") - 1, r))
    return found


def brute_kept(found):
    rank = lambda m: (m[2].priority, m[0] - m[1], m[2].rule)
    return [m for m in found if not any(g[0] <= m[0] and g[1] >= m[1] and rank(g) < rank(m) for g in found)]


def test_license_scan(docs):
    got = license_scan.scan_licenses(docs).collect()
    texts = {n: t for n, t in enumerate(TEXTS)} | {None: TEXTS[4]}
    assert len(got) == docs.count()
    for r in got:
        words = folded(texts[r.doc_id])
        found = brute_matches(words)
        assert r.n_words == len(words)
        assert sorted((d.start, d.end, d.rule) for d in r.detections) == sorted((a, b, m.rule) for a, b, m in found)
        assert sorted((d.start, d.end, d.rule) for d in r.detections if d.kept) == sorted(
            (a, b, m.rule) for a, b, m in brute_kept(found))


def test_license_report(spark, docs):
    phrases = {p.replace("<", "").split()[0]: (p.replace("<", "").split(), label) for p, label in BASE.items()}
    texts = {n: t for n, t in enumerate(TEXTS)} | {None: TEXTS[4]}
    for r in license_scan.license_report(docs).collect():
        words = folded(texts[r.doc_id])
        places = [(i, label) for p, label in phrases.values() for i in range(len(words)) if words[i:i + len(p)] == p]
        assert r.n_base == len(places)
        assert r.first_word == min((i for i, _ in places), default=None)
        assert r.last_word == max((i for i, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert {x for _, x in places} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert license_scan.license_report(spark.createDataFrame([], DOCS)).count() == 0


def test_rules_are_bounded():
    assert len(RULES) > 300 and len({r.rule for r in RULES}) == len(RULES)
    assert all(r.pattern.count(" ") < SPAN for r in RULES)
    needs = {r.pattern: license_scan.needed_word(r) for r in RULES}
    assert needs["mit <license"] == "mit" and needs["<cc by"] == "by" and needs["<gplv2"] == ""
    assert needs["(2|two) clause <bsd( license)?"] == "clause"


def vectors(rng, n, dims=6):
    rows = [(i, rng.choice([0, 1, 1, 1, 2]), [rng.randrange(-9, 10) for _ in range(dims)]) for i in range(n)]
    rows += [rows[3], rows[50], (7, 2, rows[7][2]), (100, 1, [2] * dims), (n, 1, [1, 2]), (n + 1, 1, []),
             (50, 1, [1, 2]), (n + 2, 0, [0] * dims), (150, 1, [0] * dims), (n + 3, 0, [2**40] * dims)]
    return rows


def brute_negatives(rows):
    rows = list({(i, label, tuple(p)) for i, label, p in rows})
    dot = lambda a, b: max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
    out = []
    for i, label, parts in rows:
        if i % 50:
            continue
        others = sorted((-dot(parts, p), j, la) for j, la, p in rows if len(p) == len(parts))
        chosen = [(-s, j) for s, j, la in others if la == label and j != i][:5]
        for score, j in chosen:
            fit = [(-s, m) for s, m, la in others if la != label and 50 * score <= -100 * s <= 95 * score][:3]
            out += [(i, j, n + 1, m, score, s) for n, (s, m) in enumerate(fit)]
    return sorted(out)


def test_hard_negatives(spark):
    rows = vectors(random.Random(5), 400)
    frame = spark.createDataFrame(rows, "vec_id long, label long, parts array<long>").withColumn(
        "anchor", F.col("vec_id") % 50 == 0).withColumn("key", F.lit(1)).repartition(5)
    got = hard_negatives.mine(spark, frame)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    assert hard_negatives.mine(spark, frame.limit(0)).count() == 0
    assert hard_negatives.mine(spark, frame.withColumn("anchor", F.lit(False))).count() == 0


def test_hard_negatives_in_blocks(spark):
    rng = random.Random(6)
    rows = [(i, i % 3, [rng.randrange(-4, 5) for _ in range(4000)]) for i in range(0, 2400, 25)]
    frame = spark.createDataFrame(rows, "vec_id long, label long, parts array<long>").withColumn(
        "anchor", F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, hard_negatives.mine(spark, frame, block_mb=1).collect())) == brute_negatives(rows)


# Token alignment ------------------------------------------------------------------------------

needs_files = pytest.mark.skipif(
    not (os.path.exists(token_alignment.TOKENIZER_A) and os.path.exists(token_alignment.TOKENIZER_B)),
    reason="needs the tokenizer files")
ODD = [
    (None, None), (None, "again"), (None, "again"), (5, ""), (6, " "), (7, "a▁b c"), (8, "\x00 a"),
    (9, "<s> <|endoftext|> <0x0A> hi\r\n\t  x   "), (10, "é é ﬁ 日本語 \U0001f600\U0001f600"),
    (11, "x" * 5000), (12, " " * 3000), (13, "two words"), (13, "two words"), (14, "a  b\n c \n d　 e"),
    (15, "lead  inner   trail  "), (16, "it's we'll I'd 12 345 6,7 --- !?"),
]


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(token_alignment.TOKENIZER_A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=token_alignment.TOKENIZER_B)
    letters = token_alignment._byte_of_letter()
    groups_of, held = [], Counter()
    for _, text in rows:
        groups = []
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False).ids
            b = b_model.encode(text)
            a_bytes = [bytes(letters[c] for c in a_model.id_to_token(x)) for x in a]
            b_bytes = [bytes([int(b_model.id_to_piece(x)[3:5], 16)]) if b_model.is_byte(x)
                       else b_model.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                ends = []
                for pieces in (a_bytes, b_bytes):
                    total, own = 0, []
                    for piece in pieces:
                        own.append(total := total + len(piece))
                    ends.append(own)
                both = sorted(set(ends[0]) & set(ends[1]))
                found = defaultdict(lambda: ([], []))
                for side, (ids, own) in enumerate(zip((a, b), ends)):
                    for x, end in zip(ids, own):
                        found[bisect.bisect_left(both, end)][side].append(x)
                groups = [found[g] for g in range(len(both))]
        groups_of.append(groups)
        held.update({(x, y) for p, q in groups for x in p for y in q})
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (doc, _), groups in zip(rows, groups_of):
        pairs = [(x, y) for p, q in groups for x in p for y in q]
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((doc, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(pairs),
                    sum(held[p] == best[p[0]] for p in pairs), sum(held[p] for p in pairs),
                    hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (2, v) for v in r))


@needs_files
@pytest.mark.parametrize("table_mb", [64, 0])
def test_token_alignment(spark, table_mb):
    """Also with a table that takes several passes."""
    rng = random.Random(2)
    syllables = ["un", "fort", "The", "ing", "Sch", "ü", "zig", "'s", "42", ".", "\n", " ", " ", " "]
    rows = ODD + [(100 + n, "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 200)))) for n in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("own")).withColumn(
        "n_a", F.lit(1)).repartition(4)
    got = token_alignment.align_tokens(spark, frame, table_mb=table_mb).collect()
    assert ordered(got) == ordered(brute_alignment(rows))
    assert token_alignment.align_tokens(spark, frame.limit(0)).count() == 0


@needs_files
def test_words_are_cut_where_both_tokenizers_cut():
    with open(token_alignment.TOKENIZER_A, "rb") as a, open(token_alignment.TOKENIZER_B, "rb") as b:
        of = token_alignment.Tokenizers(a.read(), b.read())
    rng = random.Random(3)
    letters = ["a", "the", "'s", "1", ".", "é", "日", " ", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "ing"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
        whole = of.encode([text])[0]
        batch, good = token_alignment.align(of, token_alignment.cut_words(text))
        assert (whole is None and not good.all()) or (whole == (batch.a.tolist(), batch.b.tolist()))


@needs_files
def test_large_groups_link_the_same_pairs(monkeypatch):
    with open(token_alignment.TOKENIZER_A, "rb") as a, open(token_alignment.TOKENIZER_B, "rb") as b:
        of = token_alignment.Tokenizers(a.read(), b.read())
    batch, _ = token_alignment.align(of, ["unforthing", "日本語é", "Schüzig", "\U0001f600\U0001f600x", "", "a"])

    def counted():
        found = Counter()
        for keys, word, times in token_alignment.links(batch, of.width):
            for k, w, n in zip(keys.tolist(), word.tolist(), times.tolist()):
                found[k, w] += n
        return found

    plain = counted()
    monkeypatch.setattr(token_alignment, "GROUP_LINKS", 1)
    assert counted() == plain and sum(plain.values()) > len(batch.a)


def test_minimal_perfect_hash():
    rng = random.Random(1)
    keys = token_alignment.np.array(sorted({rng.randrange(2**31) for _ in range(20000)}), "int64")
    bits, sizes = token_alignment.build_hash(keys)
    row = {"segment": 0, "bits": bits.tobytes(), "sizes": sizes.tobytes()}
    numbers = token_alignment.PairTable(1, [row]).numbers(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))
    by_number = token_alignment.np.empty_like(keys)
    by_number[numbers] = keys
    table = token_alignment.PairTable(1, [{**row, "keys": by_number.tobytes(), "counts": (by_number * 3).tobytes()}])
    assert (table.look_up(keys) == keys * 3).all()
    strangers = keys + 2**40
    assert (table.look_up(strangers) == 0).all()
