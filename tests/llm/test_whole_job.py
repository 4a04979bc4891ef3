"""Whole results where an earlier version cut something off."""

import random

import pytest
from pyspark.sql import functions as F

from outcomekit.llm import feistel_pii as pii, licence_scan as lic, mixing, toxicity as tox, winnowing


# ---- licence scan ---------------------------------------------------------------

def every_passage(text, least):
    """Best coefficient per licence over all passages of all lengths."""
    words = lic.normalise(text)
    found = {}
    for name, texts in lic.TEMPLATES.items():
        for t in texts:
            grams = lic.bigrams(lic.normalise(t))
            for lo in range(len(words)):
                for hi in range(lo + 2, min(len(words), lo + 2 * grams.total() + 2) + 1):
                    d = lic.dice(grams, lic.bigrams(words[lo:hi]))
                    if d >= least:
                        found[name] = max(d, found.get(name, 0.0))
    return found


def test_licence_scan_finds_notices_without_cue_words():
    known = lic.Templates(lic.TEMPLATES, 0.8)
    bsd = "Distribution and use in source and binary forms, with or without modification, are permitted"
    mit = "hereby granted, free of charge, to any person obtaining a copy of this software"
    assert known.matches(bsd)["BSD-3-Clause"] == (0.96, 1)              # 0.923 with its first word
    assert known.matches("x " + mit)["MIT"] == (pytest.approx(0.929, abs=1e-3), 1)


def test_licence_scan_ranges_over_all_passages():
    rng = random.Random(37)
    known = lic.Templates(lic.TEMPLATES, 0.8)
    noise = lambda n: [rng.choice(["the", "of", "under", "license", "version", "erst"]) for _ in range(n)]
    for texts in lic.TEMPLATES.values():
        for t in texts:
            for edits in (1, 3):
                words = t.split()
                for _ in range(edits):                     # words put in, left out or said twice
                    at = rng.randrange(len(words))
                    words[at:at + 1] = rng.choice(([], [words[at], "and"], [words[at]] * 2))
                    words = words or ["x"]
                text = " ".join(noise(4) + words + noise(4))
                assert {k: d for k, (d, _) in known.matches(text).items()} == pytest.approx(every_passage(text, 0.8))


# ---- toxicity -------------------------------------------------------------------

def test_rare_insults_are_learned_beside_many_common_stems(spark):
    rng = random.Random(43)
    ids = [r.id for r in spark.range(3000).where(~tox.held_out(F.col("id")) & (F.pmod(F.xxhash64("id"), F.lit(3)) > 0)).limit(240).collect()]
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(11)) for _ in range(4000)]
    rows = []
    for k, i in enumerate(ids):                            # 24 toxic ones; 6 of them hold the rare insult
        words = rng.sample(vocabulary, 2000) + (["zorgblat"] if k < 6 else [])
        rows.append((i, " ".join(words), int(k < 24)))
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8).cache()
    stems = tox.learn(both, both).stems
    assert any("zorgblat$".startswith(s) for s in stems)


# ---- pseudonyms -----------------------------------------------------------------

@pytest.mark.parametrize("value, text, kind", [
    ("4111 1111 1111 1111", "pay {} 123 now", "card"),
    ("4111 1111 1111 1111", "pay {} 12/27", "card"),
    ("4111-1111-1111-1111", "pay {}-2024, 3 items", "card"),
    ("4111-1111-1111-1111", "pay {}-20240101 x", "card"),
    ("4111 1111 1111 1111", "order 7731 {}", "card"),
    ("4111111111111111", "{} 4000 0000", "card"),
    ("ES91 2100 0418 4502 0005 1332", "to {} OK", "iban"),
    ("ES91 2100 0418 4502 0005 1332", "to {} 2024 PAID NOW", "iban"),
    ("GB82 WEST 1234 5698 7654 32", "to {} EUR 500", "iban"),
    ("NO93 8601 1117 947", "{} NOK", "iban"),
    ("2024-02-29", "at {}T10:00:00Z", "date"),
    ("2024-02-29", "at {}T10:00", "date"),
    ("2024-02-29", "at {}T1000", "date"),
])
def test_values_beside_other_text_are_replaced(value, text, kind):
    known = pii.Pseudonyms(b"key")
    got, counts, made = pii.pseudonymise(text.format(value), known)
    form = "iso" if kind == "date" else kind
    assert got == text.format(getattr(known, form)(value)) and value not in got
    assert counts[kind] == 1 and len(made) == 1


def test_text_without_valid_values_stays():
    known = pii.Pseudonyms(b"key")
    for text in ("4111 1111 1111 1112 and 1234 5678 9012 3456 7890 1", "2023-02-29T10:00", "ES91 2100 0418 4502 0005 1333 OK",
                 "4111111111111111x", "1 " * 500, "ISO 2024-02-29Tuesday"):
        assert pii.pseudonymise(text, known)[0] == text


# ---- winnowing ------------------------------------------------------------------

def test_passages_without_spaces_share_marks_at_any_offset(spark):
    rng = random.Random(47)
    make = lambda n: "".join(rng.choice("的一是不了人我在有他这中大来上国个到说们") for _ in range(n))     # noqa: E731
    passage, base = make(60), make(400)
    texts = [base, *[make(40 + k) + passage + make(30) for k in range(4)], base[:1] + "x" + base[1:], "a  😀 " + base]
    rows = winnowing.with_marks(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "t", "f").select(
        "i", winnowing.hashes("f").alias("h"), winnowing.positions("f").alias("at")).orderBy("i").collect()
    marks = [dict(zip(r.h, r.at)) for r in rows]
    for k in range(1, 5):
        shared = set(marks[1]) & set(marks[k])
        assert shared and all(marks[k][h] - marks[1][h] == k - 1 for h in shared)
    for k, shift in ((5, 1), (6, 5)):
        both = set(marks[0]) & set(marks[k])
        assert len(both) >= 0.9 * len(set(marks[0]) | set(marks[k]))
        assert all(marks[k][h] == marks[0][h] + shift for h in both if marks[0][h] > 0)


def test_marks_keep_their_character(spark):
    text = " the  quick\nbrown fox jumps over thelazydogwithoutanyspace at\t😀 noon, then sleeps  "
    r = winnowing.with_marks(spark.createDataFrame([(text,)], "t string"), "t", "f").first()
    assert [text[at:at + 4].split()[0] for at in r.f_q] == [
        "the", "quic", "k", "brow", "n", "fox", "jump", "s", "over",
        *["thelazydogwithoutanyspace"[k:k + 4] for k in range(22)], "at", "😀", "noon", ",", "then", "slee", "ps"]
    assert set(winnowing.MAX - (v & 0xFFFFFFFF) for v in r.f) <= set(r.f_q)


# ---- mixing ---------------------------------------------------------------------

def test_mixing_keeps_documents_whole(spark):
    text = lambda i: "\n".join(f"w{i}.{k}  x" for k in range(20 + i % 40))                     # noqa: E731
    rows = [(i, text(i), "bcd"[i % 3] if i % 4 == 0 else "c") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.mix(df, columns=["doc_id", "source"], rows_per_shard=100).collect()
    assert any(r.target < r.source_size and r.passes == 0 for r in taken)
    out = mixing.stage(spark, df, "").collect()            # one shard: a cell for each source
    cut = [r for r in out if r.text != text(r.doc_id)]
    assert len(cut) <= 3 and len(out) > 100
    assert all(text(r.doc_id).startswith(r.text) for r in cut)
