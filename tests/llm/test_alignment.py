"""Cross-tokenizer alignment against one pass over bytes and a dictionary of counts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpusmill.llm import align
from corpusmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def reference():
    """Ids and token bytes of a text by both libraries, as they come."""
    first = Tokenizer.from_file(align.FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=align.SECOND)
    letters = align.byte_level_alphabet()

    def piece_bytes(i):
        return bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        return ([(i, bytes(letters[c] for c in first.id_to_token(i))) for i in a], [(i, piece_bytes(i)) for i in b])
    return tokens


def brute_force(texts, tokens):
    """The contract by byte ranges: every pair of tokens is looked at by its spans."""
    found, holds = [], Counter()
    for text in texts:
        a, b = tokens(text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            found.append(None)
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        both = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, start = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in spans))
            start = end
        holds.update(set(links))
        found.append((len(a), len(b), len(both), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (i, _), n in holds.items():
        most[i] = max(most[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (*f[:3], len(f[3]), sum(holds[p] == most[p[0]] for p in f[3]), sum(holds[p] for p in f[3]), f[4]) for f in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

TEXTS = ["plain words here", "", None, "<|endoftext|> and </s><unk>", "a▁b", " ", "  two  blanks ", "Ünïcödé 漢字 \U0001f600 é",
         "tab\tnew\nline\r\n", "plain words here", "\x00\x1f", "x" * 5000, "ab " * 4000, "ﬁ ½ Ⅷ", "don't they'll", "１２３", " 　", "ends in blank "]


@pytest.mark.parametrize("frequent", [align.FREQUENT, 20, 0])
def test_documents_by_brute_force(spark, reference, monkeypatch, frequent):
    monkeypatch.setattr(align.frequent_pairs, "__defaults__", (frequent,))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(5)
    got = {r.id: tuple(r[c] for c in COLUMNS) for r in align.align_documents(docs).collect()}
    want = brute_force(TEXTS, reference)
    assert [got[i] for i in range(len(TEXTS))] == want
    assert want[4][0] == 0 and want[3][0] > 5      # U+2581 is not restored; strings of special tokens are text


def test_query_by_brute_force(spark, sf_dir, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in QUERIES["op13_token_alignment"](spark, sf_dir).collect()}
    assert [got[d.doc_id] for d in docs] == brute_force([d.text for d in docs], reference)


def test_gallop_places_like_binary_search():
    rng = np.random.default_rng(3)
    for _ in range(200):
        short, long = (np.unique(rng.integers(0, rng.integers(1, 3000), rng.integers(0, 600))) for _ in range(2))
        assert (align.gallop(short, long) == np.searchsorted(long, short)).all()


def test_ranges_and_groups_of_the_alignment(spark):
    docs = spark.createDataFrame([(1, "unbelievable tokenization"), (2, "")], "doc_id bigint, text string")
    encoded = align.encode_documents(docs)
    ids = {r.id: r for r in align.documents_of(encoded).collect()}
    out = {r.id: r for r in align.alignments(align.documents_of(encoded)).collect()}
    a, b = (align.encoder(open(f, "rb").read()) for f in (align.FIRST, align.SECOND))
    ends_a, ends_b = (np.cumsum(e.lengths[x]) for e, x in ((a, ids[1].a), (b, ids[1].b)))
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    assert out[1].cuts_a == [int((ends_a <= c).sum()) for c in common] and out[1].cuts_b == [int((ends_b <= c).sum()) for c in common]
    for i, (first, last) in enumerate(zip(out[1].first_b, out[1].last_b)):
        start = 0 if i == 0 else ends_a[i - 1]
        overlapping = [j for j in range(len(ends_b)) if ends_b[j] > start and (ends_b[j - 1] if j else 0) < ends_a[i]]
        assert overlapping == list(range(first, last))
    assert out[2].cuts_a == out[2].first_b == []


def test_a_vocabulary_out_of_merge_order_runs_as_it_is():
    import json
    model = json.loads(open(align.FIRST, "rb").read())
    merges = model["model"]["merges"]
    model["model"]["merges"] = [merges[1], merges[0], *merges[2:]]
    other, plain = align.byte_level(json.dumps(model).encode()), align.encoder(open(align.FIRST, "rb").read())
    assert other.encode(["a few words, again"]) == plain.encode(["a few words, again"]) and other.token_bytes == plain.token_bytes


def test_odd_tables(spark):
    schema = "doc_id bigint, text string, id string, row int, pair int, n int, a string, b string"
    empty = spark.createDataFrame([], schema)
    assert align.align_documents(empty).collect() == []
    rows = [(None, "same words", "x", 1, 1, 1, "", ""), (None, "same words", "x", 1, 1, 1, "", ""), (3, None, None, None, None, None, None, None), (3, "same words", *[None] * 6)]
    got = sorted((r.id or 0, r.n_a, r.count_sum) for r in align.align_documents(spark.createDataFrame(rows, schema)).collect())
    n = got[-1][1]
    assert got == [(0, n, 3 * n), (0, n, 3 * n), (3, 0, 0), (3, n, 3 * n)]
    broken = spark.createDataFrame([(1,)], "doc_id bigint").selectExpr("doc_id", "cast(x'c328' as string) as text")
    assert [r.n_a for r in align.align_documents(broken).collect()] == [0]
