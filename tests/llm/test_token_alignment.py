import hashlib
import random
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import token_alignment as ta


@lru_cache
def whole():
    """Both tokenizers as they are, and the bytes of their ids."""
    a = Tokenizer.from_file(ta.A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.B_PATH)
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    letter = {chr(x if x in visible else next(other)): x for x in range(256)}
    a_bytes = {i: bytes(letter[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b_bytes = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        b_bytes[i] = bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def brute_tokens(text):
    a, b, a_bytes, b_bytes = whole()
    raw = b" " + (text or "").encode()
    x, y = a.encode(" " + text, add_special_tokens=False).ids if text else [], b.encode(text) if text else []
    if b"".join(a_bytes[i] for i in x) != raw or b"".join(b_bytes[i] for i in y) != raw:
        return [], []
    return [(i, a_bytes[i]) for i in x], [(i, b_bytes[i]) for i in y]


def brute(rows):
    """Group and link each text byte by byte."""
    found = []
    for i, text in rows:
        sides, covers = [], []
        for tokens in brute_tokens(text):
            ends, cover = [], []
            for k, (_, raw) in enumerate(tokens):
                cover += [k] * len(raw)
                ends.append(len(cover))
            sides.append((tokens, ends))
            covers.append(cover)
        (x, x_ends), (y, y_ends) = sides
        links = sorted(set(zip(*covers, strict=True)))
        both, groups = sorted(set(x_ends) & set(y_ends)), []
        for low, high in zip([0, *both], both, strict=False):
            inside = lambda ends: range(bisect_right(ends, low), bisect_right(ends, high))
            sides_of = [",".join(str(t[k][0]) for k in inside(ends)) for t, ends in ((x, x_ends), (y, y_ends))]
            groups.append("|".join(sides_of))
        found.append((i, len(x), len(y), ";".join(groups), len(groups), [(x[j][0], y[k][0]) for j, k in links]))
    count = Counter(p for r in found for p in r[5])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, n, m, groups, n_groups, links in found:
        out.append((i, n, m, n_groups, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), groups))
    return sorted(out, key=repr)


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum".split()


def aligned(df, **options):
    return sorted((tuple(r[c] for c in [*COLUMNS, "groups"]) for r in ta.align(df, **options).collect()), key=repr)


WORDS = ["the", "The", "uncharacteristically", "naïve", "Größe", "日本語", "don't", "it's", "  ", "   ", "\n", "\t ", "\r\n ", "\xa0", "　", "\x1c", "\x85", "12345", "3.14", "<s>", "</s>", "<|endoftext|>", "<0x41>", "<unk>", "é", "👩‍🚀", " ", "a" * 30, "!!!", "_", "\x00", "½", "Ⅷ", "١٢", "​", "﻿", "\U0001f1e9"]


def text_of(rng, n):
    return "".join(rng.choice(WORDS) + rng.choice(["", " ", " ", "  "]) for _ in range(n))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.builds(text_of, st.randoms(use_true_random=False), st.integers(0, 40)))
def test_stretches_encode_like_whole_texts(text):
    pair = ta.load(ta.A_PATH, ta.B_PATH)
    (a, b), _, right = pair.encode(ta.stretches(text))
    x, y, a_bytes, b_bytes = whole()
    if text:
        assert a.tolist() == x.encode(" " + text, add_special_tokens=False).ids and b.tolist() == y.encode(text)
    assert right.all() == ("▁" not in text)


def test_all_letters_of_the_base_planes(spark):
    """Each code point beside letters, digits, signs and spaces: the two encoders of A agree on what it is."""
    pair = ta.load(ta.A_PATH, ta.B_PATH)
    assert pair._fast is not None
    for first in range(0, 0x30000, 0x400):
        letters = [chr(c) for c in range(first, first + 0x400) if not 0xD800 <= c < 0xE000 and c != 0x2581]
        text = "".join(f"a{c}1{c} {c}. {c}\n" for c in letters)
        (a, b), _, right = pair.encode(ta.stretches(text))
        if text:
            assert a.tolist() == whole()[0].encode(" " + text, add_special_tokens=False).ids, hex(first)
            assert b.tolist() == whole()[1].encode(text) and right.all(), hex(first)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(1, 4), min_size=1, max_size=80), st.integers(1, 12))
def test_pieces_of_the_merge(a, b, steps):
    ends = [np.cumsum(x) for x in (a, b)]
    last = max(e[-1] for e in ends)
    a, b = (np.unique(np.append(e, last)) for e in ends)
    i, j = ta.merge_path(a, b, steps)
    assert (np.diff(i + j)[:-1] == steps).all() and i[-1] == len(a) and j[-1] == len(b)
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    assert [sum(1 for m in merged[:n] if m[1] == 0) for n in (i + j)] == i.tolist()
    of_a, of_b = ta.overlaps(a, b, steps)
    assert of_a.tolist() == [int((b < x).sum()) for x in a] and of_b.tolist() == [int((a < x).sum()) for x in b]


@pytest.mark.parametrize("chunk_bytes", [1, 300, 8 << 20])
def test_equals_brute_force(spark, docs, chunk_bytes):
    rng = random.Random(3)
    rows = [(i, text_of(rng, rng.randint(0, 30))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "a▁b c"), (104, "▁"), (None, "the cat"), (None, None), *rows[:5]]
    df = docs(*rows).withColumns({"chunk": F.lit(1), "a.b": F.lit("x"), "groups": F.lit(3), "code": F.lit(0)}).repartition(3)
    assert aligned(df, chunk_bytes=chunk_bytes) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.builds(text_of, st.randoms(use_true_random=False), st.integers(1, 60)), st.integers(1, 40))
def test_long_texts_are_aligned_in_pieces(text, most):
    pair = ta.load(ta.A_PATH, ta.B_PATH)
    assert text == " ".join(ta.pieces(text, most))
    (cols, kinds, counts), (want, k, n) = ta.align_long(text, pair, most), ta.align_chunk([text], pair)
    assert cols == want and kinds.tolist() == k.tolist() and counts.tolist() == n.tolist()


def test_no_rows_and_rows_without_tokens(spark, docs):
    assert aligned(docs()) == []
    assert aligned(docs((1, None), (2, ""))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_long_texts_without_spaces(spark, docs):
    rows = [(1, "ab" * 200_000), (2, "z" * 5_000), (3, "the cat " * 50_000), (4, "é\n" * 20_000)]
    got = aligned(docs(*rows))
    want = [(i, *(len(x) for x in brute_tokens(t))) for i, t in rows]
    assert [r[:3] for r in got] == want
    assert all(r[4] == r[1] + r[2] - r[3] and r[5] > 0 for r in got)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(rows)]
    got = [tuple(r[c] for c in [*COLUMNS, "groups_sha256"]) for r in ta.op13_token_alignment(spark, sf_dir).collect()]
    assert sorted(got, key=repr) == want
