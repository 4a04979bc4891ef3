"""Licence scan, pseudonyms, toxicity, quality and the pipeline."""

import collections
import datetime
import random

import pytest

from outcomekit.llm import feistel_pii as pii, licence_scan as lic, ordinal_quality as oq, toxicity as tox
from outcomekit.llm.common import table

SF = "/root/testdata/sf0.01"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- licence scan ---------------------------------------------------------------

def brute_matches(text, least):
    """Best coefficient per licence over all passages of all lengths."""
    words = lic.normalise(text)
    found = {}
    for name, texts in lic.TEMPLATES.items():
        for t in texts:
            grams = lic.bigrams(lic.normalise(t))
            for lo in range(len(words)):
                left, common = dict(grams), 0
                for hi in range(lo + 1, len(words)):                  # one more bigram of the passage at a time
                    (g,) = lic.bigrams(words[hi - 1:hi + 1])
                    if left.get(g, 0):
                        left[g] -= 1
                        common += 1
                    d = 2 * common / (grams.total() + hi - lo)
                    if d >= least:
                        found[name] = max(d, found.get(name, 0.0))
    return found


def test_licence_scan_matches_brute_force():
    rng = random.Random(31)
    noise = lambda n: " ".join(rng.choice(["the", "of", "under", "version", "thnd", "erst"]) for _ in range(n))
    known = lic.Templates(lic.TEMPLATES, 0.8)
    for name, texts in lic.TEMPLATES.items():
        for t in texts:
            for text in (t, t.upper(), noise(30) + " " + t + " " + noise(30), noise(5) + "\n" + t + "\n" + noise(9),
                         " | ".join(t.split()), noise(60)):
                got = {k: d for k, (d, _) in known.matches(text).items()}
                assert got == pytest.approx(brute_matches(text, 0.8))
                if t in text:
                    assert got[name] == 1.0


def test_licence_scan_query_shape(spark):
    rows = [(1, None), (2, ""), (3, "x\nReleased under the MIT License."), (3, "x\nReleased under the MIT License."), (None, "a " * 90_000)]
    out = lic.scan_licences(docs_of(spark, rows)).collect()
    assert sorted(len(r.hits) for r in out) == [0, 0, 0, 1, 1]
    assert lic.scan_licences(docs_of(spark, [])).count() == 0


# ---- pseudonyms -----------------------------------------------------------------

def test_feistel_is_a_permutation():
    for size in (1, 2, 3, 10, 97, 1000):
        assert sorted(pii.permute(v, size, b"k", "t") for v in range(size)) == list(range(size))
    assert [pii.permute(v, 1000, b"k", "t") for v in range(50)] != [pii.permute(v, 1000, b"j", "t") for v in range(50)]


def test_pseudonyms_keep_format_validity_and_links():
    known = pii.Pseudonyms(b"key")
    rng = random.Random(41)
    cards = set()
    for _ in range(300):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        v = body + str(pii.luhn_digit(body))
        p = known.card(v)
        assert len(p) == 16 and int(p[-1]) == pii.luhn_digit(p[:-1]) and p[0] == "4"
        cards.add((v, p))
    assert len({v for v, _ in cards}) == len({p for _, p in cards})
    assert known.card("4111 1111 1111 1111")[4] == " " and known.card("4111111111111112") is None
    assert known.card("4111 1111 1111 1111").replace(" ", "") == known.card("4111111111111111")
    ssn = known.ssn("123-45-6789")
    assert pii._valid_ssn(int(ssn.replace("-", ""))) and known.ssn("000-12-3456") is None
    iban = "GB82 WEST 1234 5698 7654 32"
    p = known.iban(iban)
    s = p.replace(" ", "")
    assert s[:2] == "GB" and int(s[2:4]) == pii.iban_check("GB", s[4:]) and s[4:8].isalpha() and len(p) == len(iban)
    day = known.iso("2024-02-29")
    assert datetime.date.fromisoformat(day) and known.iso("2023-02-29") is None
    assert datetime.datetime.strptime(known.dmy("29.02.2024"), "%d.%m.%Y").date().isoformat() == day
    assert known.ip("300.1.2.3") is None and all(int(x) < 256 for x in known.ip("10.0.0.1").split("."))


def test_pseudonymise_documents(spark):
    card = "4111111111111111"
    rows = [(1, f"pay {card}. +1 (415) 555-3221 and 10.1.2.3, born 1999-12-31 a.b7@x.org"), (2, f"again {card}\né"),
            (3, None), (4, ""), (4, ""), (None, "nothing 12 here v1.2"), (7, "4111111111111112 id")]
    out = {(r.id, r.text): r for r in pii.pseudonymise_documents(docs_of(spark, rows), b"k").collect()}
    by = {i: t for i, t in out}
    new = by[2].split()[1]
    assert new != card and by[1].startswith(f"pay {new}. +1 (") and card not in by[1] and "@x.org" in by[1]
    assert "10.1.2.3" not in by[1] and "1999-12-31" not in by[1]
    assert by[None] == "nothing 12 here v1.2" and by[7] == "4111111111111112 id" and by[3] == ""
    assert pii.pseudonymise_documents(docs_of(spark, [])).count() == 0


# ---- toxicity -------------------------------------------------------------------

def test_grammar_weighs_the_clause():
    lexicon = tox.Lexicon({"idiot$": 4.0, "moro": 2.0})
    total = lambda t: tox.features(t, lexicon)[0]                                             # noqa: E731
    plain = total("an idiot came")
    assert plain == 4.0 and total("morons came") == 2.0 and total("idiotic") == 0.0
    assert total("you are an idiot") > plain > total("it said an idiot came") > 0
    assert total("not an idiot") < plain
    assert total("i will kill you") == 4.0 and total("kill the light") == 0.0 and total("") == 0.0


def test_composition_multiplies_factors():
    both = tox.compose(tox.NEGATED, tox.REPORTED)
    state, seen = both.start, []
    for s in (tox.REPORT, tox.NEGATION, tox.INSULT):
        state, f = both.move(state, s)
        seen.append(f)
    assert seen == [1.0, 1.0, 0.125]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = tox.query(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.95
    assert sum(r.predicted for r in rows if not r.toxic) == 0


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = docs_of(spark, [(1, None), (2, ""), (None, "you idiot, you moron, pathetic loser"), (3, "x" * 200_000), (3, "a")])
    model = tox.learn(docs, labels)
    out = tox.score(docs, model, ["doc_id"]).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.score >= 0.5} == {None}
    assert tox.score(docs_of(spark, []), model, ["doc_id"]).count() == 0


# ---- quality --------------------------------------------------------------------

def test_quality_separates_grades(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    ratings = oq.graded(labels)
    train, test = ratings.where("i % 5 <> 0"), labels.where("doc_id % 5 = 0")
    model = oq.learn(docs, train)
    assert (model.thresholds[1:] > model.thresholds[:-1]).all()
    rows = oq.grade_documents(docs, model).withColumnRenamed("id", "doc_id").join(test, "doc_id").collect()
    assert sum((r.p_good >= 0.5) == (r.quality == 1) for r in rows) / len(rows) >= 0.95
    assert all(r.p_good >= r.p_best and abs(r.p_good + r.p_best - r.expected_grade) < 1e-9 for r in rows)


def test_quality_edges(spark):
    none = oq.learn(docs_of(spark, [(1, "a")]), spark.createDataFrame([], "i long, grade int"))
    out = oq.grade_documents(docs_of(spark, [(1, None), (None, ""), (2, "x"), (2, "x")]), none).collect()
    assert none is None and len(out) == 4 and all(r.p_good == 0.5 for r in out)


# ---- pipeline -------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline
    from outcomekit.llm import content_sort, mixing, parity_join
    from outcomekit.llm.common import written

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_duplicates", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    predicted = {r.doc_id: r.predicted for r in tox.query(spark, SF).collect()}
    clean = written(tox.stage(spark, docs, SF), "t")
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, p in predicted.items() if not p}

    groups = collections.defaultdict(list)
    for r in clean.collect():
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")].append(r.doc_id)
    unique = written(content_sort.stage(spark, clean, SF), "u")
    assert sorted(r.doc_id for r in unique.collect()) == sorted(max(g) for g in groups.values())

    label = {r.id: r.component_id for r in parity_join.similarity_components(unique).collect()}
    single = written(parity_join.stage(spark, unique, SF), "s")
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(label.values()))

    mixed = written(mixing.stage(spark, single, SF), "m")
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix(single).collect()}
    words = collections.Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert words == collections.Counter({k: v for k, v in taken.items() if v})

    packed = corpus_pipeline.run(spark, SF).collect()
    total = collections.Counter()
    for r in packed:
        total[r.doc_id] += r.words
    assert +total == words
