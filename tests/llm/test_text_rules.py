"""Folding, letters and page parsing at their edges."""

import itertools
import random

import numpy as np
import pytest

from corpusmill.llm import html, langid, toxicity


@pytest.mark.parametrize("text", ["idiot", "ＩＤＩＯＴ", "𝐢𝐝𝐢𝐨𝐭", "𝓘𝓭𝓲𝓸𝓽", "ⓘⓓⓘⓞⓣ", "ïdïöt", "ïdïöt", "іdiоt", "1D10T", "i­di​ot", "ɪdɪot".replace("ɪ", "ı"), "ídìőť"])
def test_folding(text):
    assert toxicity.fold(text) == "idiot"


def test_folding_leaves_other_signs():
    assert toxicity.fold("½ ² 5 kg, 10%") == "½ ² 5 kg, 10%"


def test_matcher_by_substrings():
    rng = random.Random(4)
    entries = {"".join(rng.choice("ab") for _ in range(n)) + end: 1.0 for n in (2, 3, 4) for end in ("", "$") for _ in range(4)}
    matcher = toxicity.Matcher(toxicity.ToxicityModel(entries))
    for _ in range(300):
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 8))]
        want = sorted(e for w in words for e in entries if (w == e[:-1] if e.endswith("$") else w.startswith(e)))
        assert sorted(h[0] for h in matcher.hits(" ".join(words))) == want


@pytest.mark.parametrize("text, letter", [("½ ²", False), ("Ⅷ ①", False), ("12_3 !", False), ("", False), ("7 é", True), ("漢", True), ("ª", True)])
def test_letters(text, letter):
    assert langid.has_letter(text) is letter
    model = langid.LanguageModel(("a", "b"), np.array([[1.0], [-1.0]]), np.zeros((2 * langid._SLOTS, 1), np.float32))
    assert (model.predict(text)[0] == langid.UNKNOWN) is not letter


def test_decoding_by_all_codewords():
    rng = np.random.default_rng(1)
    code = langid.codewords(5)
    weights = rng.normal(size=(2 * langid._SLOTS, code.shape[1])).astype(np.float32)
    model = langid.LanguageModel(tuple("vwxyz"), code, weights)
    for text in ("one two", "Ünder", "x"):
        slots = langid.gram_slots(text)
        margins = weights[slots].astype(float).sum(axis=0) / len(slots) ** 0.5
        losses = [sum(np.log1p(np.exp(-bit * m)) for bit, m in zip(word, margins)) for word in code]
        best = int(np.argmin(losses))
        language, score, _ = model.predict(text)
        assert language == "vwxyz"[best] and abs(score - 1 / sum(np.exp(losses[best] - v) for v in losses)) < 1e-9


def whole(source):
    page = html.parse(source, labelled=False)
    return html.page_text(page, [True] * len(page.tag))


@pytest.mark.parametrize("name", ["button", "select", "noscript", "template", "svg"])
def test_unclosed_elements_lose_nothing(name):
    assert whole(f"<article><p>one <{name}> two</p><p>three</p></article><p>four</p>") == "one two three four"
    assert whole(f"<article><p>one <{name}>no</{name}> two</p><p>three</p></article>") == "one two three"
    assert whole(f"<article><p>one <{name} width=1 /> two</p><p>three</p></article>") == "one two three"
    assert whole(f"<div><p>one</p><{name}>no</div><p>two</p><{name}>no</{name}>") == "one two"


def test_hidden_parts_and_heads():
    assert whole("<p>a<svg><g/><path d=x><title>no</title><text>no</text></svg>b</p>") == "ab"
    assert whole("<p>one</p><button>no<p>two</p><button>no</button>") == "one two"
    assert whole("<noscript><p>no</p><div>no</div></noscript><p>one</p>") == "one"
    assert whole("plain text <head> stays") == "plain text stays"
    assert whole("<html><head><title>no < no</title><meta x></head><body>one</body></html>") == "one"
    assert whole("<title>no<p>one</p>") == "one"
    assert whole("<p>one</p><script>no <p>no</p>") == "one"
    assert whole("<p>one</p><textarea>no</textarea><iframe>no</iframe><style>no</style> two") == "one two"


@pytest.mark.parametrize("mark", ["left", "0.5", "", "7"])
def test_foreign_marks_do_not_matter(spark, sf_dir, mark):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(20)
    forest = html.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    sources = [r.html or "" for r in pages.collect()]
    marked = [s.replace("<div", f'<div data-y="{mark}"').replace("<p", f'<p data-y="{mark}"') for s in sources]
    assert html.extract(marked, forest) == html.extract(sources, forest)


def test_decoding_by_all_consistent_choices():
    rng = np.random.default_rng(0)
    page = html.parse("<div><p>a few words</p><div><p>b</p></div></div><nav>d, e</nav>")
    n = len(page.tag)
    choices = [c for c in itertools.product("kds", repeat=n) if all(c[page.parent[i]] in ("s", c[i]) for i in range(1, n))]
    weight = np.log1p(np.array(page.chars)) + 0.05
    for _ in range(100):
        margin = rng.normal(0, 3, n)
        no = -np.logaddexp(0, margin) * weight
        yes = no + margin * weight
        value = {"k": yes, "d": no, "s": np.maximum(yes, no) - html.SWITCH_COST}
        best = max(choices, key=lambda c: sum(value[s][i] for i, s in enumerate(c)))
        assert html.decode(page, margin) == [s == "k" or s == "s" and margin[i] > 0 for i, s in enumerate(best)]
