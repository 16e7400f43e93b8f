import hashlib
import random
import re

import pytest

from prefspark.llm import pii

SF = "/root/testdata/sf0.01"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def noisy(rng):
    bits = ["a@b.c", "x.y+z@h-1.example.org", "@", ".", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123.456-78", "+1", "  ", "-", "9", "é", "🎉", "_", "a_b@c.d_e@f.gh", "1.2.3.4.5.6.7.8", "\n", "+12 3456 7890 1234 5678"]
    return "".join(rng.choice(bits) + rng.choice(["", " ", "."]) for _ in range(rng.randrange(0, 14)))


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    texts = [noisy(rng) for _ in range(400)] + ["a" * 50_000, "1" * 50_000, "1." * 20_000, "a@" * 5_000, "+1 " * 3_000, "1 " * 50_000]
    rows = pii.find(frame(spark, texts)).collect()
    for r in rows:
        got = [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r["base"]]
        assert got == base(texts[r["id"]]), texts[r["id"]][:80]
        assert all(s["value"] == texts[r["id"]][s["start"] : s["end"]] for s in r["base"])


def test_query_digests(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = pii.query(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = base(docs[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in want) for k in PLAIN]
        assert r["spans"] == line or r["spans"].startswith(line + ",term:") or (not line and r["spans"] == "")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    texts = [f"{word()} {word()} write to Zaphod at zb{k}@ex.example.org {word()} {word()}" for k in range(40)]
    texts += [f"{word()} Quillon {word()} reach me@secret.example.org {word()}" for _ in range(5)]
    texts += [texts[0]] * 30 + ["Quillon was here"]
    return texts


def test_revealing_terms_become_spans(spark, corpus):
    rows = {r["id"]: r for r in pii.find(frame(spark, corpus)).collect()}
    for k in range(40, 45):
        terms = {corpus[k][s["start"] : s["end"]] for s in rows[k]["terms"]}
        assert "Quillon" in terms
    # A word beside many entities, and what stands beside an entity only in copies, reveal nothing.
    assert all(rows[k]["terms"] == [] for k in range(40)) and rows[75]["terms"] == []


def test_sanitised_text(spark, corpus):
    texts = [*corpus, "+49 30 123456 and 4111 1111 1111 1111 at 1.2.3.4", None, "", "clean 12 text"]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, texts)).collect()}
    n = len(corpus)
    assert out[n] == "[PHONE] and [CARD] at [IP]"
    assert (out[n + 1], out[n + 2], out[n + 3]) == (None, "", "clean 12 text")
    assert "[TERM]" in out[41] and "[EMAIL]" in out[41] and "Quillon" not in out[41]
    assert "Zaphod" in out[3]


def test_a_revealing_term_is_marked_anywhere_in_a_document_with_the_entity(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    fill = lambda n: " ".join(word() for _ in range(n))
    far = [f"Quillon {fill(60)}\n{fill(20)} me@secret.example.org {fill(3)}.\n\n{fill(30)} (quillon) {fill(2)}" for _ in range(6)]
    other = [f"{fill(9)} zb{k}@ex.example.org {fill(9)}" for k in range(60)]
    rows = {r["id"]: r for r in pii.find(frame(spark, far + other)).collect()}
    for k, text in enumerate(far):
        assert [(s["start"], s["end"], s["value"]) for s in rows[k]["terms"]] == [(m.start(), m.end(), "quillon") for m in re.finditer("(?i)quillon", text)]
    assert all(rows[k]["terms"] == [] for k in range(6, 66))
    out = pii.sanitise(frame(spark, far + other)).where("doc_id < 6").collect()
    assert all(r["text"].count("[TERM]") == 2 and "uillon" not in r["text"] for r in out)


def test_statistics_are_of_the_whole_corpus(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    held = [f"{word()} common Quillon {word()} me@secret.example.org {word()}" for _ in range(4)]
    others = [f"{word()} {word()} zb{k}@ex.example.org {word()}" for k in range(40)]
    plain = [f"{word()} common {word()} words" for _ in range(60)]
    rows = {r["id"]: r for r in pii.find(frame(spark, held + others + plain)).collect()}
    assert all([s["value"] for s in rows[k]["terms"]] == ["quillon"] for k in range(4))
    # Few documents with entities, many without: N is that of the corpus, so the name still reveals.
    few = held + [f"{word()} common {word()}" for _ in range(60)]
    rows = {r["id"]: r for r in pii.find(frame(spark, few)).collect()}
    assert all([s["value"] for s in rows[k]["terms"]] == ["quillon"] for k in range(4))


def test_copies_of_a_long_list_make_few_pairs(spark):
    """A list of addresses and names in edited copies: pairs are of classes, and what reveals is still found."""
    name = lambda k: "per" + "".join("abcdefghij"[int(c)] for c in f"{k:03d}")
    people = " ".join(f"{name(k).title()} person{k}@corp.example.org" for k in range(120))
    rows = [(k, f"{people} edition{k}x") for k in range(4)] + [(10 + k, f"plain words about nothing {k % 7}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = pii.find(df).where("id < 4").collect()
    assert all(len(r["base"]) == 120 and {t["value"] for t in r["terms"]} >= {name(k) for k in range(120)} for r in held)
    near = spark.createDataFrame([(r, r, f"e{k}", 4) for r in range(4) for k in range(400)], "row bigint, key bigint, entity string, n_e bigint")
    own = spark.createDataFrame([(r, f"t{k}", 4) for r in range(4) for k in range(400)], "row bigint, term string, n_t bigint")
    assert pii.class_pairs(pii.with_class(near, "entity", "e"), pii.with_class(own, "term", "t")).count() == 4
