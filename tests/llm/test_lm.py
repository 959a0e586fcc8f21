"""LM scoring: base counts, the bits of words and the bits before words, against plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import lm, lm_lead, lm_match, lm_words

CODE = lm_words.Code(np.bincount(np.frombuffer(b"abcabcabc  defu/", np.uint8), minlength=256))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, target double, row long, block long"


def frame(spark, texts):
    return spark.createDataFrame([(k, x, "en", None, 0, 9, 1.5, 1, 1) for k, x in enumerate(texts)], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    found = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 200))) for _ in range(30)]
    found += [found[0], found[0] + " more", None, "", " \t\n", "one", "Two Words", "x" * 5000, "word " * 900 + "end", "again and again and again and"]
    found += [" ".join(found[4].split()[20:]) + " tail", found[5]]
    return found


@pytest.fixture(scope="module")
def scored(spark, texts):
    return {r.doc_id: r for r in lm.score_texts(frame(spark, texts).repartition(3), F.col("doc_id") % 4 != 1).collect()}


def test_base_and_counts(texts, scored):
    count, split = Counter(), {k: [*words(x), b""] for k, x in enumerate(texts)}
    for k, w in split.items():
        if k % 4 != 1:
            count.update(w)
    n, v = sum(count.values()), len(count)
    assert len(scored) == len(texts)
    for k, r in scored.items():
        w = split[k]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (len(w), sum(count[x] > 0 for x in w), n, k % 4 != 1)
        assert abs(r.base_score - sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w)
        assert r.score < 0 and np.isfinite(r.score) and r.n_bytes == len((texts[k] or "").encode())


def test_a_copy_costs_little_and_order_counts(spark, texts, scored):
    # Text 41 is a held-out copy of text 5, which is held out too; text 30 copies text 0, and both are in training.
    assert scored[30].score > 0.3 * scored[30].base_score
    turned = list(texts)
    turned[33] = " ".join(reversed(texts[0].split()))
    turned[37] = texts[0]
    got = {r.doc_id: r for r in lm.score_texts(frame(spark, turned), F.col("doc_id") % 4 != 1).collect()}
    # Held-out rows with the same words: the copy of a training text, and its words backwards.
    assert abs(got[33].base_score - got[37].base_score) < 1e-9 and got[37].score > 0.5 * got[33].score


def test_edges(spark):
    assert lm.score_texts(frame(spark, []), F.lit(True)).count() == 0
    none = lm.score_texts(frame(spark, ["a b", None]), F.lit(False)).collect()
    assert [(r.train_tokens, r.n_known) for r in none] == [(0, 0)] * 2 and all(r.score < 0 for r in none)
    twice = spark.createDataFrame([(None, "a b c", "en", None, 0, 9, 1.5, 1, 1)] * 3, SCHEMA)
    assert len({r.score for r in lm.score_texts(twice, F.lit(True)).collect()}) == 1


def test_blocks_that_change_are_noticed(spark):
    import pyarrow as pa

    rows = pa.table({"doc_id": [1], "train": [True], "text": ["a b"], "row": [0], "own": [True]})
    known = pa.table({"number": [lm.planes(np.array([0, 2], np.int32))], "logs": [lm.planes(np.zeros(8, np.int32))], "counts": [lm.planes(np.ones(2, np.int64))], "row": pa.array([None], pa.int64()), "like": pa.array([None], pa.int64())})
    with pytest.raises(ValueError, match="changed"):
        lm._scores(rows, known, np.zeros(4), 1.0)


def tables_of(known):
    out = np.zeros((lm_words.Layout.total, 2), np.int64)
    lm_words.count_tables(known, out)
    return out


def test_word_model_is_a_distribution():
    names = [bytes([a, b]) for a in b"abc" for b in b"abc"] + [b"", b"a" * 60] + [b"abc" + bytes([a, b]) for a in b"xyz" for b in b"xyz"]
    known = lm_words.Words(names, np.tile([[3, 1, 0, 0]], (len(names), 1)), np.full(len(names), 3), CODE)
    tables, mixer = tables_of(known), lm_words.Mixer()
    lm_words.learn_mixer(known, lm_words.Tables(tables), mixer)
    logs = lm_words.word_scores(known, lm_words.Tables(tables), mixer)
    assert (np.exp(logs).sum(0) <= 1 + 1e-6).all() and (logs < 0).all() and np.exp(logs).sum(0)[0] > 0.5


def test_exact_contexts_are_those_of_plain_counting():
    rng = random.Random(3)
    names = sorted({bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    counts = np.random.default_rng(1).integers(0, 4, (len(names), 4))
    known = lm_words.Words(names, counts, np.full(len(names), 3), CODE)
    closed = [names[k] + b" " for k in known.order]
    spelled = {b: f"{CODE.bits[CODE.rank[b]]:0{CODE.length[CODE.rank[b]]}b}" for b in range(256)}
    assert all(not x.startswith(y) for k, x in spelled.items() for j, y in spelled.items() if j != k and k < 128)
    bits = ["".join(spelled[b] for b in w) for w in closed]
    assert bits == sorted(bits)
    at = np.zeros(len(names), int)
    for live, bit, _, _, _, _, ones, zeros in known.walk():
        for j, w in enumerate(live.tolist()):
            path = bits[w][: at[w]]
            for value, found in ((1, ones), (0, zeros)):
                wanted = known.counts[[k for k, b in enumerate(bits) if b.startswith(path + str(value))]].sum(0)
                assert found[j].tolist() == [wanted.sum(), *wanted.tolist()]
            assert bits[w][at[w]] == str(int(bit[j]))
            at[w] += 1
        if at.max() > 20:
            break


def test_long_words_are_modelled_to_their_end(monkeypatch):
    names = [b"u" * 50 + b"/one" * 9, b"u" * 50 + b"/two" * 9, b"v" * 40 + b"xyz" * 20, b"short", b""]
    known = lm_words.Words(names, np.array([[900, 1, 0, 0], [1, 0, 0, 0], [50, 0, 0, 7], [3, 0, 0, 0], [9, 9, 0, 0]]), np.full(5, 3), CODE)
    tables, mixer = tables_of(known), lm_words.Mixer()
    lm_words.learn_mixer(known, lm_words.Tables(tables), mixer)
    logs = lm_words.word_scores(known, lm_words.Tables(tables), mixer)
    monkeypatch.setattr(lm_words, "DEEP_BYTES", 10_000)
    assert (tables_of(known) == tables).all()
    assert np.allclose(lm_words.word_scores(known, lm_words.Tables(tables), mixer), logs)


def test_first_bytes_with_many_words_are_dealt_by_more():
    words_ = [b"abcdefghijklmn", b"abcdefghijklzz", b"abcdefxx", b"abcq", b"ab", b"xyz", b""]
    data, ends = np.frombuffer(b"".join(words_), np.uint8), np.cumsum([len(w) for w in words_])
    cold = np.zeros(lm.PREFIX_SLOTS, bool)
    key, depth = lm.dealt(data, ends, [cold, cold])
    assert len(set(key[:4])) == 1 and len(set(key)) == 4 and (depth == 3).all()
    key, depth = lm.dealt(data, ends, [~cold, cold])
    assert key[0] == key[1] == key[2] != key[3] and (depth == 6).all()
    key, depth = lm.dealt(data, ends, [~cold, ~cold])
    assert key[0] == key[1] != key[2] and (depth == 12).all()


def plain_bits(like, own):
    """The bits of one text, one at a time: (place, candidate, hit, probability)."""
    m, end = lm_match, object()
    rates = [(m.FIRST_RATES * m.FIRST_COUNT).ravel().tolist(), [0.7 * m.FIRST_COUNT] * m.FREQUENCIES, (m.FIRST_PASTS * m.FIRST_COUNT).tolist()]
    rates = [[[x, m.FIRST_COUNT] for x in r] for r in rates]
    weights, cells = [list(m.FIRST_WEIGHTS) for _ in range(m.GATES)], [[0.0, 0.0] for _ in range(m.CELLS)]
    before = {}
    for p, w in enumerate(like):
        for n in (4, 2):
            if p >= n:
                before[n, tuple(like[p - n : p])] = (w, ("like", p))
    outcome, out, waiting, run, last = {}, [], [], 0, None
    chunk_of = lambda p: p // m.CHUNK if p < m.EARLY else m.EARLY // m.CHUNK + (p - m.EARLY) // m.LATE_CHUNK
    for p, w in enumerate([*own, end]):
        if waiting and chunk_of(p) != waiting[0][0]:
            for _, g, x, q, cell, contexts, y in waiting:
                weights[g] = [a + m.RATE * (y - q) * b for a, b in zip(weights[g], x, strict=True)]
                for c in (cells[cell], *(r[k] for r, k in zip(rates, contexts, strict=True))):
                    c[0] += y
                    c[1] += 1
            waiting = []
        found = next(((n, before[n, tuple(own[p - n : p])]) for n in (4, 2) if p >= n and (n, tuple(own[p - n : p])) in before), None)
        if found is None:
            last = None
        else:
            n, (word, source) = found
            hit, long = word == w, int(n == 4)
            run = run + 1 if last == (source[0], source[1] - 1) else 0
            last = source
            past = outcome.get(source, 0) + 3 * (source[0] == "like")
            contexts = (long * m.RUNS + min(run, m.RUNS - 1), len(word) % m.FREQUENCIES, past)
            x = [math.log(q / (1 - q)) for q in (min(max(r[k][0] / r[k][1], 0.002), 0.998) for r, k in zip(rates, contexts, strict=True))] + [0.3]
            g = long * 3 + min((min(run, m.RUNS - 1) + 2) // 3, 2)
            mixed = min(max(sum(a * b for a, b in zip(weights[g], x, strict=True)), -8), 8)
            q = 1 / (1 + math.exp(-mixed))
            cell = round(mixed) + m.CELLS // 2
            out.append((p, word, hit, min(max((q + (cells[cell][0] + 16 * q) / (cells[cell][1] + 16)) / 2, 0.001), 0.999)))
            waiting.append((chunk_of(p), g, x, q, cell, contexts, float(hit)))
            outcome[("own", p)] = 1 + hit
        for n in (4, 2):
            if p >= n and w is not end:
                before[n, tuple(own[p - n : p])] = (w, ("own", p))
    return out


def test_bits_before_words_against_plain_python():
    rng = random.Random(9)
    vocabulary = ["a", "bb", "ccc", "dd", "e", "fff", "gggg"]
    pairs = []
    for _ in range(12):
        like = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 90]))]
        own = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 60, 1500]))]
        pairs.append((like, own[:20] + like[5:80] + own[20:]))
    number = {w: k + 1 for k, w in enumerate(vocabulary)}
    tokens, place, owner, own_, common = [], [], [], [], []
    for k, (like, own) in enumerate(pairs):
        for mine, text in ((False, like), (True, [*own, None])):
            tokens += [number.get(w, 0) for w in text]
            place += range(len(text))
            owner += [k] * len(text)
            own_ += [mine] * len(text)
            common += [len(w or "") % lm_match.FREQUENCIES for w in text]
    at, s, hit, p = lm_match.match_bits(np.array(tokens, np.uint64), np.array(place), np.array(owner), np.array(own_), np.array(common), len(pairs))
    for k, (like, own) in enumerate(pairs):
        mine = np.array(owner)[at] == k
        got = list(zip(np.array(place)[at][mine].tolist(), np.array(tokens)[s][mine].tolist(), hit[mine].tolist(), p[mine].tolist(), strict=True))
        wanted = plain_bits(like, own)
        assert [(a, number[b], c) for a, b, c, _ in wanted] == [g[:3] for g in got]
        assert np.allclose([x[3] for x in wanted], [g[3] for g in got])


def test_hashed_contexts_count_every_occurrence():
    names, counts = [b"ab", b"ac", b"b"], np.array([[3, 0, 2, 0], [1, 0, 0, 0], [0, 4, 0, 0]])
    out = tables_of(lm_words.Words(names, counts, np.zeros(3, int), CODE))
    bits = [sum(int(CODE.length[CODE.rank[b]]) for b in name + b" ") for name in names]
    for t in range(len(lm_words.ORDERS)):
        assert out[lm_words.Layout.starts[t] : lm_words.Layout.starts[t + 1]].sum() == sum(b * n for b, n in zip(bits, counts.sum(1), strict=True))
    for c in range(lm_words.CLASSES):
        t = lm_words.Layout.of_class + c
        assert out[lm_words.Layout.starts[t] : lm_words.Layout.starts[t + 1]].sum() == sum(b * n for b, n in zip(bits, counts[:, c], strict=True))


def piece_of(texts):
    import pyarrow as pa

    (piece,) = lm.pieces(pa.array(texts), 1 << 20)
    return lm.lowered(piece)


@pytest.mark.parametrize("lead", [1, 3])
def test_lead_contexts_are_those_of_plain_counting(monkeypatch, lead):
    assert lm_lead.END == 1 << 24 | 0x20 << 8 * (lm_lead.LEAD - 1)
    monkeypatch.setattr(lm_lead, "LEAD", lead)
    monkeypatch.setattr(lm_lead, "END", np.uint32(1 << 24 | 0x20 << 8 * (lead - 1)))
    monkeypatch.setattr(lm_lead, "AT_ONCE", 50)
    monkeypatch.setattr(lm_lead, "BITS", [20] * len(lm_lead.BITS))
    monkeypatch.setattr(lm_lead, "STARTS", np.arange(len(lm_lead.BITS) + 1) << 20)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "Bc", "abc", "defabcd", "cab", "efabcd"]) for _ in range(rng.randint(0, 40))) for _ in range(12)]
    wanted = [Counter() for _ in lm_lead.BITS]
    for text in texts:
        before = None
        for word in [*words(text), b""]:
            past, so_far = b" " * 6 if before is None else (b" " * 6 + before + b" ")[-6:], b""
            for byte in (word + b" ")[:lead]:
                symbol = CODE.rank[byte]
                spelled = f"{CODE.bits[symbol]:0{CODE.length[symbol]}b}"
                for j, bit in enumerate(spelled):
                    contexts = [*((past + so_far)[-n:] for n in lm_lead.ORDERS), so_far, (before, so_far)]
                    for count, context in zip(wanted, contexts, strict=True):
                        count[context, spelled[:j], bit] += 1
                so_far += bytes([byte])
            before = word
    low = piece_of(texts)
    _, leads, n = lm_lead.distinct(lm_lead.text_leads(low, low.word_hashes()))
    out = np.zeros((len(lm_lead.BITS) << 20, 2), np.int32)
    lm_lead.count_leads(leads, n, CODE, out)
    for t, count in enumerate(wanted):
        got = out[t << 20 : (t + 1) << 20].ravel()
        assert sorted(got[got > 0].tolist()) == sorted(count.values())


def test_leads_are_a_distribution_that_knows_the_word_before():
    low = piece_of(["abc fed abc fed abc fed def cab def cab"] * 20)
    _, leads, n = lm_lead.distinct(lm_lead.text_leads(low, low.word_hashes()))
    out = np.zeros((lm_lead.TOTAL, 2), np.int32)
    lm_lead.count_leads(leads, n, CODE, out)
    tables, mixer = lm_lead.LeadTables(out), lm_lead.new_mixer()
    lm_lead.learn_leads(leads, n, CODE, tables, mixer)
    some = leads.take(np.repeat(np.arange(len(leads)), 256))
    some.lead = np.tile(np.uint32(1 << 24) | np.arange(256, dtype=np.uint32) << np.uint32(8 * (lm_lead.LEAD - 1)), len(leads))
    chance = np.exp(lm_lead.lead_scores(some, CODE, tables, mixer)).reshape(-1, 256)
    assert np.allclose(chance.sum(1), 1, atol=1e-5)
    after = {chr(leads.back[k] >> np.uint64(8) & np.uint64(255)): chance[k] for k in range(len(leads))}
    assert after["c"][ord("f")] > 0.5 > after["b"][ord("f")]


def test_the_word_before_counts(spark):
    # Two words each, so that no bit before a word tells one from the other; a row in five is held out.
    pairs = [("north", "apple"), ("south", "berry")]
    texts = [" ".join(pairs[k % 2]) for k in range(200)]
    texts[5], texts[10] = "north apple", "north berry"
    got = {r.doc_id: r for r in lm.score_texts(frame(spark, texts), F.col("doc_id") % 5 != 0).collect()}
    assert abs(got[5].base_score - got[10].base_score) < 0.1 and got[5].score > got[10].score + 0.5


def test_bits_that_words_share_are_walked_once():
    rng = random.Random(8)
    names = sorted({bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    known = lm_words.Words(names, np.random.default_rng(2).integers(0, 4, (len(names), 4)), np.full(len(names), 3), CODE)
    spelled = {b: f"{CODE.bits[CODE.rank[b]]:0{CODE.length[CODE.rank[b]]}b}" for b in range(256)}
    bits = ["".join(spelled[b] for b in names[k] + b" ") for k in known.order]
    wanted = {w[: j + 1] for w in bits for j in range(len(w))}
    at, walked = np.zeros(len(names), int), 0
    for low, high, bit, *_ in known.nodes():
        walked += len(low)
        for a, b, y in zip(low.tolist(), high.tolist(), bit.tolist(), strict=True):
            assert {w[: at[a] + 1] for w in bits[a:b]} == {bits[a][: at[a]] + str(y)}
            at[a:b] += 1
    assert walked == len(wanted) < sum(map(len, bits)) / 2 and at.tolist() == [len(w) for w in bits]


def test_tasks_walked_together_score_as_they_do_alone():
    def row(names, counts):
        return {
            "m": len(names), "names": b"".join(names), "sizes": lm.planes(np.array([len(x) for x in names], np.int32)),
            "depth": bytes([3] * len(names)), "counts": lm.planes(np.array(counts, np.int64).ravel()),
        }

    rows = [row([b"abcd", b"abce", b"xyz"], [[3, 1, 0, 0], [1, 0, 0, 2], [0, 0, 0, 0]]), row([b"abdd", b"aa", b""], [[5, 0, 0, 0], [0, 2, 0, 0], [9, 9, 9, 9]])]
    out = np.zeros((lm_words.Layout.total, 2), np.int64)
    for r in rows:
        lm_words.count_tables(lm._loaded([r], CODE, True), out)
    together = lm._loaded(rows, CODE, True)
    assert (tables_of(together) == out).all()
    tables, mixer = lm_words.Tables(out), lm_words.Mixer()

    def scores(some):
        known = lm._loaded(some, CODE, False)
        logs = np.empty((len(known.sizes), lm_words.CLASSES))
        logs[known.order] = lm_words.word_scores(known, tables, mixer)
        return logs

    assert np.allclose(scores(rows), np.concatenate([scores([r]) for r in rows]), atol=1e-5)
