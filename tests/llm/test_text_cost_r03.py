"""What the text operators spend: pairs looked at once, pieces encoded once."""

import numpy as np
import pytest

from outcomekit.llm import concat_cut
from outcomekit.llm import repair_tokens as rp


def recounted(ids, least):
    """Re-Pair that counts all pairs in each round."""
    seq, rules = ids.tolist(), []
    while True:
        count = {}
        for p in zip(seq, seq[1:]):
            count[p] = count.get(p, 0) + 1
        lefts, rights, taken = set(), set(), []
        for a, b in sorted((p for p in count if count[p] >= least), key=lambda p: (-count[p], p)):
            if a in rights or b in lefts or (a == b and a in lefts):
                continue
            lefts.add(a)
            rights.add(b)
            taken.append((a, b))
        if not taken:
            return rules, seq
        name = {p: rp.FIRST_RULE + len(rules) + i for i, p in enumerate(sorted(taken))}
        rules += sorted(taken)
        out, i = [], 0
        while i < len(seq):
            pair = tuple(seq[i:i + 2])
            out.append(name.get(pair, seq[i]))
            i += 2 if pair in name else 1
        seq = out


@pytest.mark.parametrize("values,least", [(1, 2), (2, 2), (5, 3), (40, 8), (400, 2)])
def test_rounds_over_few_places_equal_a_full_recount(values, least):
    rng = np.random.default_rng(values)
    ids = np.concatenate([np.resize(rng.integers(0, values, 23), 600), rng.integers(0, values, 900)]).astype(np.uint32)
    rules, seq = rp.compress(ids, least)
    want_rules, want = recounted(ids, least)
    assert rules.tolist() == [list(r) for r in want_rules] and seq.tolist() == want
    assert (rp.decompress(rules, rp.expansion_lengths(rules), seq) == ids).all()


def test_later_rounds_look_at_changed_places_only(monkeypatch):
    """A pair that is rare in one round is not counted again in the next."""
    rng, counted, count = np.random.default_rng(3), [], np.bincount
    ids = np.concatenate([rng.integers(0, 1 << 19, 50_000), np.resize(np.arange(64), 4_096)]).astype(np.uint32)
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: (counted.append(len(x)), count(x, *a, **k))[1])
    rp.compress(ids)
    assert len(counted) > 4 and sum(counted[1:]) < len(ids)


def test_the_encoder_outlives_a_task():
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert rp.encoder(path) is rp.encoder(path) is concat_cut.encoder(path)
