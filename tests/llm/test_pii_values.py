"""Discovered identifiers of several tokens, long ones, and long chains of discovery."""

from pyspark.sql import functions as F

from corpusmill.llm import pii


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}


def whole(kind, text, value):
    at = text.index(value)
    return f"{kind}:{at}:{at + len(value)}"


def test_grouped_and_long_values(spark):
    seeds = [f"tel: +1 555 010 {1000 + i} end" for i in range(40)]
    seeds += [f"host: 10.1.{i}.7 up" for i in range(40)]
    seeds += [f"mail: user{i}@example.org sent" for i in range(40)]
    seeds += [f"card: {n} paid" for n in luhn_cards(40)]
    long = "@" + "x" * 80
    cases = [("phone", "tel: {} end", "(555) 123-9876"), ("phone", "tel: {} end", "555 123 9876"), ("card", "card: {} paid", "4111 1111 1111 1112"),
             ("ip", "host: {} up", "2001:db8:0:0:1:2:3:4"), ("ip", "host: {} up", "fe80::1:2"), ("email", "mail: {} sent", long)]
    texts = [t.format(v) for _, t, v in cases]
    got = found(spark, seeds + texts)
    for i, ((kind, _, value), text) in enumerate(zip(cases, texts)):
        assert got[len(seeds) + i] == whole(kind, text, value), value
    docs = spark.createDataFrame(list(enumerate(seeds + texts)), "doc_id bigint, text string")
    assert pii.redact(docs).where(f"doc_id = {len(seeds)}").first().text == "tel: [phone] end"


def test_discovery_goes_on_until_nothing_is_added(spark):
    levels = [[f"{k}{i:07}" for i in range(n)] for k, n in enumerate((2592, 432, 72, 12, 2))]
    rows = []
    for k, values in enumerate(levels):
        around = [f"{side}{p} _" for side in "ab" for p in (k - 1, k) if p >= 0]
        rows += [(-1 if k else 3, v, around) for v in values]
    got = pii.bootstrap(spark.createDataFrame(rows, "kind int, value string, contexts array<string>"))
    assert {r.value for r in got.where(F.col("kind") == 3).collect()} == {v for values in levels[1:] for v in values}


def test_a_number_beside_a_fixed_format_stays_a_candidate():
    text = "tel: 555 123 9876 10.0.0.1 up"
    assert [(k, v) for k, _, _, v, _ in pii.occurrences(text, pii.base_spans(text))] == [(1, "10.0.0.1"), (-1, "555 123 9876")]


def test_counts_are_of_the_kind_wherever_its_spans_stand(spark):
    texts = ["+1 555 010 12345 4111 1111 1111 1111x 1.2.3.4 a@b.co", "a@b.co c@d.ee e@f.org", "1.2.3.4 5.6.7.8 +1 555 010 12345 g@h.org", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_pii(docs).collect()}
    want = {i: tuple(sum(k == kind for k, _, _ in pii.base_spans(t or "")) for kind in range(4)) for i, t in enumerate(texts)}
    assert got == want and got[1] == (3, 0, 0, 0) and got[2] == (1, 2, 0, 1)


def luhn_cards(n):
    out, i = [], 0
    while len(out) < n:
        digits = f"4000{i:012}"
        if pii._luhn(digits):
            out.append(" ".join(digits[k:k + 4] for k in range(0, 16, 4)))
        i += 1
    return out


def test_few_texts_are_strings_at_a_time():
    import pyarrow as pa
    from corpusmill.llm.common import ROWS_AT_ONCE
    n = 2 * ROWS_AT_ONCE + 7
    spans = [[{"kind": 0, "start": 3, "end": 8}] if i % 3 == 0 else None for i in range(n)]
    batch = pa.record_batch([pa.array(range(n)), pa.array([f"to a@b.c {i}" for i in range(n)]), pa.array(spans)], ["doc_id", "text", "spans"])
    out = list(pii._redact_task(["doc_id", "text"])(iter([batch])))
    assert max(b.num_rows for b in out) <= ROWS_AT_ONCE and pa.Table.from_batches(out).column("doc_id").to_pylist() == list(range(n))
    assert [t for b in out for t in b.column(1).to_pylist()] == [f"to [email] {i}" if i % 3 == 0 else f"to a@b.c {i}" for i in range(n)]
