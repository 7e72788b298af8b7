"""Operators against brute force, round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from corpusmill.llm import html, imatch, langid, pii, simhash, suffix, toxicity, warc, winnow
from corpusmill.llm.components import connected_components
from corpusmill.llm.queries import QUERIES


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def words(rng, k, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(k)]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1064)] + [(2000, i) for i in range(2001, 2100)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == want


@pytest.mark.parametrize("crowded", [1, 16])
def test_simhash_links_are_exact(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(1)
    bases = [rng.getrandbits(64) for _ in range(20)]
    fps = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(4))) for b in bases for _ in range(15)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"))
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in edges.collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}
    assert got <= want

    def groups(pairs):
        parent = {f: f for f in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        return {f: find(f) for f in signed}

    assert groups(got) == groups(want)


def test_simhash_fingerprint():
    text = "The the THE cat sat on on on the mat É"
    tokens = text.encode().lower().split()
    grams = [b" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)]
    bits = [sum(xxhash.xxh64_intdigest(g, 42) >> i & 1 for g in grams) * 2 > len(grams) for i in range(64)]
    assert simhash.simhash64(text.encode()) % (1 << 64) == sum(1 << i for i, b in enumerate(bits) if b)
    assert simhash.simhash64(b" \n") == 0


@pytest.mark.parametrize("crowded", [2, 256])
def test_repeated_spans_by_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix, "CROWDED", crowded)
    rng = random.Random(2)
    passages = [words(rng, rng.randrange(45, 140)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = [words(rng, rng.randrange(0, 60)), rng.choice(passages), words(rng, rng.randrange(0, 40))]
        if rng.random() < 0.3:
            parts.insert(0, ["again"] * 70)
        texts.append(" ".join(w for p in parts for w in p))
    texts += [texts[0], texts[3], "short", ""]
    seen, want = {}, {}
    tokens = [t.split() for t in texts]
    for i, t in enumerate(tokens):
        gone = set()
        for at in range(len(t) - 49):
            if seen.get(tuple(t[at:at + 50]), i) < i:
                gone.update(range(at, at + 50))
        for at in range(len(t) - 49):
            seen.setdefault(tuple(t[at:at + 50]), i)
        want[i] = (len(gone), " ".join(w for k, w in enumerate(t) if k not in gone))
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in rows_of(suffix.drop_repeated_spans(docs_of(spark, texts)))}
    assert got == want

    holders = {}
    for i, t in enumerate(tokens):
        for at in range(len(t) - 49):
            holders.setdefault(tuple(t[at:at + 50]), set()).add(i)
    spans = set()
    for i, t in enumerate(tokens):
        hits = [at for at in range(len(t) - 49) if len(holders[tuple(t[at:at + 50])]) > 1]
        for k, at in enumerate(hits):
            if k == 0 or hits[k - 1] != at - 1:
                first = at
            if k + 1 == len(hits) or hits[k + 1] != at + 1:
                spans.add((i, first, at + 50 - first, " ".join(t[first:at + 50])))
    repeats = [(r["doc_id"], r["first_word"], r["n_words"], r["span"]) for r in rows_of(suffix.maximal_repeats(docs_of(spark, texts)))]
    assert spans and len(repeats) == len(spans) and set(repeats) == spans


def test_subtree_nodes_by_brute_force():
    rng = random.Random(8)
    stem = words(rng, 84)
    rows = [stem[:rng.randrange(50, 84)] + words(rng, 90, 2) for _ in range(30)] + [["same"] * 70] * 3
    rows = [r[:84] for r in rows] + [words(rng, 50)]
    ids = [rng.randrange(20) for _ in rows]
    places, ranks = suffix.suffix_array([" ".join(r).encode() for r in rows])
    assert len(ranks) == 8 and len(set(ranks[-1].tolist())) == len(ranks[-1]) == sum(len(r) + 1 for r in rows)

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for earlier in (True, False):
        want = []
        for i, r in enumerate(rows):
            last = 0
            for at in range(len(r) - 49):
                deep = max((common(r[at:], o[b:]) for j, o in enumerate(rows) if (ids[j] < ids[i] if earlier else ids[j] != ids[i]) for b in range(len(o) - 49)), default=0)
                reach = at + deep if deep >= 50 else 0
                if reach > last:
                    want.append((i, at, reach))
                last = reach
        zeros = np.zeros(len(rows), np.int64)
        got = suffix.deep_repeats(np.array(ids), zeros, np.array([len(r) - 50 for r in rows]), [" ".join(r).encode() for r in rows], earlier)
        assert got == want and want


@pytest.mark.parametrize("limit", [3, 12, 1000])
def test_prefixes_are_lengthened_until_they_fit(spark, monkeypatch, limit):
    """Windows that share 16, 30 or all words come out alike whichever step their group fits at."""
    monkeypatch.setattr(suffix, "CROWDED", limit)
    rng = random.Random(9)
    stem = words(rng, 30)
    tails = [words(rng, 40) for _ in range(6)]
    texts = [" ".join(words(rng, rng.randrange(9)) + stem[:rng.choice([16, 30])] + tails[i % 6]) for i in range(36)]
    got = {r["doc_id"]: r["n_removed"] for r in rows_of(suffix.drop_repeated_spans(docs_of(spark, texts)))}
    tokens, seen = [t.split() for t in texts], {}
    for i, t in enumerate(tokens):
        windows = {at: tuple(t[at:at + 50]) for at in range(len(t) - 49)}
        assert got[i] == len({w for at, x in windows.items() if seen.get(x, i) < i for w in range(at, at + 50)})
        for x in windows.values():
            seen.setdefault(x, i)


def test_winnowing_finds_every_shared_window(spark):
    rng = random.Random(4)
    items = [" ".join(words(rng, k)) for k in (3, 7, 10, 11, 40, 40)] + ["!!", "Straße É 12"]
    texts = []
    for _ in range(60):
        parts = [words(rng, rng.randrange(30))]
        source = rng.choice(items).split()
        cut = rng.randrange(len(source)) if source else 0
        parts += [source[cut:cut + rng.randrange(1, 25)], words(rng, rng.randrange(30))]
        texts.append(rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.3 else w for p in parts for w in p))
    texts += ["straße É 12 und", "straße é 12"]

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))

    got = {r["doc_id"]: r for r in rows_of(winnow.contamination(docs_of(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")))}
    for i, t in enumerate(texts):
        w, hit, named = split(t), set(), set()
        for k, item in enumerate(items):
            v = split(item)
            n = min(10, len(v))
            windows = {tuple(v[a:a + n]) for a in range(len(v) - n + 1)} if n else set()
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit.update(range(a, a + n))
                    named.add(str(k))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) == (len(w), len(hit), len(named))
        assert got[i]["items_sha256"] == hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()


PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(6)
    alphabet = "0123456789.@+- ()ab%_é"
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60))) + rng.choice(["", "4111111111111111", "+1 (017) 555-7713", "a@b.c@d.e.f"])
        want = []
        for k, (name, pattern) in enumerate(PATTERNS):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                doubled = sum(int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
                if (name == "email" or name == "ip" and max(map(int, m.group().split("."))) <= 255
                        or name == "card" and 14 <= len(digits) <= 19 and doubled % 10 == 0 or name == "phone" and 10 <= len(digits) <= 15):
                    want.append((k, m.start(), m.end()))
        assert pii.base_spans(text) == sorted(want, key=lambda s: (s[1], s[0])), text


def test_bootstrap_discovers_what_a_pattern_surrounds(spark):
    texts = [f"call tel: +1 ({i:03d}) 555-{1000 + i} today" for i in range(12)] + [f"see page {i}{i}{i}111 here" for i in range(1, 9)]
    texts += ["call tel: 555-123-9876 today", "order 555-777-1234 was sent"]
    got = {r["doc_id"]: r["spans"] for r in rows_of(pii.find_pii(docs_of(spark, texts)))}
    assert got[20] == "phone:10:22" and got[21] == "" and got[13] == ""
    assert pii.replace_spans("ab cd ef", [(0, 0, 2), (1, 1, 5), (3, 6, 8)]) == "[email] [phone]"


def test_toxicity_folds_and_respects_exceptions(spark, sf_dir):
    assert toxicity.fold("1D10T іdiоt IDＩOT idi​ot c10wn costs $5") == "idiot idiot idiot idiot ciown costs $5"
    model = toxicity.ToxicityModel({"idiot$": 4.0, "ciow": 2.0}, frozenset({"usefui idiot$"}), 0.0, 5.0, -2.0)
    m = toxicity.Matcher(model)
    assert m.total("An 1d10t, clowns!")[0] == 6.0 and m.total("a useful idiot")[0] == 0 and m.total("idiotic xclow useful")[0] == 0
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op4_toxic_lexicon"](spark, sf_dir))}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_toxicity_held_out(spark):
    table = "/root/testdata/sf0.1"
    got = QUERIES["op4_toxic_lexicon"](spark, table).join(spark.read.parquet(f"{table}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.97
    assert got.score[got.toxic == 1].mean() > 0.8 and got.score[got.toxic == 0].mean() < 0.05


def test_language_held_out(spark):
    table = "/root/testdata/sf0.1"
    got = QUERIES["op7_language_ecoc"](spark, table).join(spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.99
    code = langid.codewords(20)
    gaps = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(20) * 99
    assert gaps.min() >= code.shape[1] // 4


def test_imatch_by_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(words(rng, rng.randrange(0, 300), 3000)) for _ in range(60)] + ["é" * 7, ""]
    got = {r["doc_id"]: r for r in rows_of(imatch.fingerprint_edits(docs_of(spark, texts)))}
    n = len(texts)
    for i, t in enumerate(texts):
        after = texts[(i - 1) % n]
        third = len(t) // 3
        edited = t[:len(t) - third] + after[:third]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        assert got[i]["near_next"] == imatch.likeness(got[i]["fingerprint"], got[(i - 1) % n]["fingerprint"])
    counts = Counter(x for t in texts for x in set(t.split()))
    band = {x for x, c in counts.items() if 2 <= c <= 0.1 * n}
    have = set(imatch.lexicon(docs_of(spark, texts)).tolist())
    assert have == {int(imatch.term_hashes(x)[0]) for x in band if x.isascii()} | {int(imatch.term_hashes(x)[0]) for x in band if not x.isascii()}


def test_pages_in_unseen_layouts(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    forest = html.fit(pages)
    rng = random.Random(77)
    texts = [" ".join(words(rng, 12)).capitalize() + "." for _ in range(400)]
    hit = wrong = missed = 0
    for _ in range(60):
        source = html.dress(rng.choice(texts)[:40], rng.sample(texts, rng.randrange(2, 9)), texts, rng)
        page = html.parse(source)
        want = Counter(html.page_text(page, [v == 1 for v in page.label]).split())
        got = Counter(html.extract([re.sub(" data-y=[01]", "", source)], forest)[0].split())
        hit += sum((want & got).values())
        wrong += sum((got - want).values())
        missed += sum((want - got).values())
    assert hit / (hit + wrong) > 0.97 and hit / (hit + missed) > 0.97


def test_page_decoding_has_no_contradictions():
    page = html.parse("<div><p>a</p><div><p>b</p></div></div><nav><a href=x>c</a></nav>")
    rng = np.random.default_rng(0)
    for _ in range(200):
        margin = rng.normal(0, 3, len(page.tag))
        kept = html.decode(page, margin)
        assert len(kept) == len(page.tag)
    assert html.page_text(page, [True] * len(page.tag)) == "a b c"
    assert html.page_text(html.parse("x <b>bo</b>ld&amp;\n\n y<br>z<script>'<p>'</script><!-- <p>no -->"), [True]) == "x bold& y z"


def test_archives_hold_the_payloads(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    again = pages.unionByName(pages.withColumn("page_id", pages["page_id"] + 1000))
    archives, folder = warc.archive_pages(again, f"file://{tmp_path}/warc")
    back = {r["page_id"]: r for r in rows_of(warc.read_archives(archives, folder))}
    want = {r["page_id"]: r["html"] for r in rows_of(pages)}
    assert len(back) == 2 * len(want) and sum(r["records"] for r in rows_of(archives)) == len(back)
    for i, text in want.items():
        assert bytes(back[i + 1000]["payload"]).decode() == text and back[i]["payload"] is None
        assert back[i]["record_type"] == "revisit" and back[i]["refers_to"] == i + 1000
    name = archives.first()["archive"]
    with open(name, "rb") as f:
        assert int.from_bytes(f.read(4), "little") == warc.SKIPPABLE
    small, folder = warc.archive_pages(again, f"file://{tmp_path}/small", smallest_revisit=10**9)
    assert warc.read_archives(small, folder).where("record_type = 'revisit'").count() == 0
