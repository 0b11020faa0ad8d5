"""The corpus operators on small texts: exact round trips, brute force and defined results for nulls, empty and long texts."""

import os
import random
import time

import numpy as np
import pytest

from rainloom.llm import encode, leak, subject
from rainloom.llm.transducer import Transducer, Utf8Stream, parse_ranks

VOCABULARY = f"{encode.FOLDER}/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ALPHABET = "ab 'sretvmld  \n\t\ré漢1٣²!?.<|\x1c\x85​\U0001f600́ ﻿"


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_ids_equal_a_public_encoder_and_decode_to_the_text(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = encode.parse_ranks(open(VOCABULARY, "rb").read())
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [None, "", " ", "a" * 3000, " " * 700, "<|endoftext|>", "I'll we've x's 's", "word " * 20000]
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    ids = encode.encode_corpus(docs)
    got = dict(ids.collect())
    assert len(got) == len(texts) and all(got[i] == (other.encode_ordinary(t) if t else []) for i, t in enumerate(texts))
    assert dict(encode.decode_corpus(ids).collect()) == {i: t or "" for i, t in enumerate(texts)}
    assert encode.encode_corpus(docs.limit(0)).count() == 0


def test_incremental_utf8():
    rng = random.Random(1)
    for _ in range(300):
        data = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED]) for _ in range(rng.randint(0, 20)))
        s, cut = Utf8Stream(), rng.randint(0, 20)
        assert s.feed(data[:cut]) + s.feed(data[cut:]) + s.close() == data.decode("utf-8", "replace")


WORDS = "the quiet miller carried seven painted barrels from Ostrava to the mayor's cellar before the first frost asking nine silver coins and a loaf of dark bread for his trouble while the baker swore by her ring that no wagon had passed the bridge since noon on Monday so they agreed to share the rest".split()


def _items(spark):
    return spark.createDataFrame([(1, "b", "en", " ".join(WORDS)), (2, "b", "en", "too short to leak"), (3, "b", "en", None)], "item_id long, bench string, lang string, passage string")


def test_leaks(spark):
    broken = list(WORDS[5:40])
    broken[6], broken[27] = "fron", ""
    texts = {
        1: "Before. " + " ".join(WORDS) + " After.",
        2: " ".join(WORDS).upper().replace(" ", "\n").replace("BARRELS", "BAR-\nRELS"),
        3: "x " + " ".join(broken) + " y",
        4: " ".join(WORDS[:12]) + "\nCRT-002 - page 4\n[17] " + " ".join(WORDS[12:30]),
        5: " ".join(WORDS[10:28]) + " and nothing else of it",
        6: " ".join(w if i % 6 else "other" for i, w in enumerate(WORDS)),
        7: None,
        8: "",
        9: "filler words here " * 20000 + " ".join(WORDS),
        10: "  \n ",
    }
    docs = spark.createDataFrame([(k, v, 0) for k, v in texts.items()] + [(1, texts[1], 0)], "doc_id long, text string, item_id int")
    out = sorted(tuple(r) for r in leak.leaks(docs, _items(spark)).select("doc_id", "item_id").collect())
    assert out == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (9, 1)]
    assert sorted(r.doc_id for r in leak.without_leaks(docs, _items(spark)).collect()) == [5, 6, 7, 8, 10]
    assert leak.leaks(docs.limit(0), _items(spark)).count() == 0 and leak.leaks(docs, _items(spark).limit(0)).count() == 0


REPEATING = "the keeper of the old northern lighthouse wrote in his book that the keeper of the old northern lighthouse had seen two ships and a boat pass while rain fell on the keeper of the old northern lighthouse and all who slept there through that long winter night".split()


def _found(items, texts):
    return {d for d, _, _ in leak.Passages(items).find(texts)}


def test_leaks_of_a_passage_that_repeats_a_phrase():
    cuts = [REPEATING[i : i + 25] for i in range(len(REPEATING) - 24)]
    texts = [" ".join(c) for c in cuts]
    texts += ["Then " + " ".join(REPEATING[30:]) + " came again: " + t for t in texts]
    texts += ["x " + " ".join(c[:12]) + " Page 7 of 9. " + " ".join(c[12:]) + " y" for c in cuts]
    texts += [" ".join(REPEATING[:12]) + " but not so in this place " * 40 + t for t in texts[: len(cuts)]]
    assert _found([(5, " ".join(REPEATING))], texts) == set(range(len(texts)))
    short = [" ".join(REPEATING[i : i + 22]) for i in range(len(REPEATING) - 21)]
    assert not _found([(5, " ".join(REPEATING))], [f"{t} or nothing more" for t in short])


def test_leaks_with_two_words_lost_and_three_insertions():
    def parted(cut, lost, insertions):
        words = ["zzz" if i in lost else w for i, w in enumerate(cut)]
        return "x " + " ".join(w + " [CRT-002] page 4 of 7" * (i in insertions) for i, w in enumerate(words)) + " y"

    cuts = [WORDS[i : i + 25] for i in range(len(WORDS) - 24)]
    texts = [parted(c, lost, ins) for c in cuts for lost, ins in (((4, 13), (8, 17, 21)), ((8, 16), (3, 12, 20)), ((12, 20), (4, 8, 16)))]
    assert _found([(5, " ".join(WORDS))], texts) == set(range(len(texts)))
    assert not _found([(5, " ".join(WORDS))], [parted(c, (3, 4, 13), (8, 17, 21)) for c in cuts])
    rng = random.Random(2)
    points = np.array([rng.choice([97, 98]) for _ in range(500)], np.uint32)
    for gram in range(leak.LEAST_GRAM, leak.GRAM + 1):
        windows = [tuple(points[i : i + gram]) for i in range(501 - gram)]
        hashes = leak.gram_hashes(points, gram).tolist()
        assert len(hashes) == len(windows) and len(set(hashes)) == len(set(windows)) == len(set(zip(hashes, windows)))


TERMS = {"sea": ["harbour", "anchor", "rudder", "sailor", "keel", "tide"], "farm": ["plough", "harvest", "barn", "cattle", "orchard", "fodder"], "law": ["appeal", "statute", "clause", "verdict", "hearing", "motion"]}


def _decision(rng, subject_paragraphs):
    out = []
    for s in subject_paragraphs:
        words = [rng.choice(TERMS[s]) for _ in range(4)] if s else []
        out.append(f"[{len(out) + 1}] The parties came before the court and spoke of " + ", the ".join(words or ["file"]) + ".")
    return "\n".join(out)


def test_subjects(spark):
    rng = random.Random(7)
    rows, truth, labels = [], set(), []
    for i in range(400):
        a, b = rng.sample(list(TERMS), 2)
        two = i % 4 == 0
        rows.append((i, _decision(rng, [a, None, a] + ([b, b] if two else [None]) + [None])))
        want = {a, b} if two else {a}
        truth |= {(i, s) for s in want}
        if i % 3 == 0:
            labels += [(i, s) for s in (want if i % 30 else {b})]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, _decision(rng, ["sea", None]))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, subject string")
    subjects = spark.createDataFrame([(s, f"About {t[0]} and {t[1]}") for s, t in TERMS.items()], "subject string, description string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string")
    out = {tuple(r) for r in subject.subjects_of(docs, subjects, lab).collect()}
    assert len(out & truth) / len(out) > 0.97 and len(out & truth) / len(truth) > 0.97 and not {d for d, _ in out} & {1000, 1001, 1002, 1003}
    assert subject.subjects_of(docs, subjects, lab.limit(0)).count() == 0 and subject.subjects_of(docs.limit(0), subjects, lab).count() == 0


def test_paragraphs():
    text = "CRT-002 / P-00000199/1998\nHead\n[1] One\ntwo.\n- 3 -\nthree.\n[2] Four.\n[3] Five."
    assert subject.paragraphs(text) == ["Head", "[1] One two. three.", "[2] Four.", "[3] Five."]
    assert subject.paragraphs("A one.\n\nB two.\n\nC three\n\nand on.\n\nD.") == ["A one.", "B two.", "C three and on.", "D."]
    assert subject.paragraphs("A one.\nB two\nand on.\nC.") == ["A one.", "B two and on.", "C."] and subject.paragraphs(None) == []


def test_terms_are_parted_once_and_counted_in_what_was_encoded(spark):
    docs = spark.createDataFrame([(1, "[1] Kéel tide.\n[2] an Anchor"), (2, "p. 3 anchor\n[1] TIDE tide\u2028rudder"), (3, "unlabelled tide"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, [0]), (2, [0, 1]), (4, [1])], "doc_id long, s array<int>")
    assert subject.words("Ab’s ﬁn d'é\n1x\n") == [b"ab", b"s", b"fin", b"d", b"e", b"0", b"x", b"0"]
    counts = {r[0]: r[1] for r in subject.term_counts(docs.join(labels, "doc_id"), 2).collect()}  # no other texts are parted here
    assert counts == {"keel": [1, 0], "tide": [2, 1], "anchor": [2, 1], "rudder": [1, 1]}
    encoded = subject.encode_paragraphs(docs, ["anchor", "keel", "rudder", "tide"])
    ids = {r[0]: r[1] for r in encoded.collect()}
    assert ids == {1: [1, 3, -1, 0, -1], 2: [-2, 3, 3, 2, -1], 3: [3, -1], 4: []}
    assert subject.document_counts(encoded, 4).tolist() == [2, 1, 1, 3]


def test_run_sums_equal_reduceat_in_less_time():
    rng = np.random.default_rng(3)
    values, index = rng.standard_normal((1000, 112)), rng.integers(0, 1000, 25_000)
    first = np.append(0, np.flatnonzero(rng.random(len(index)) < 0.25)[1:])

    def seconds(f):
        began = time.thread_time()
        f()
        return time.thread_time() - began

    slow, fast = (lambda: np.add.reduceat(values[index], first, axis=0)), (lambda: subject.run_sums(values, index, first))
    assert np.allclose(slow(), fast()) and np.allclose(subject.run_sums(values, index[:1], np.array([0])), values[index[:1]])
    assert min(seconds(fast) for _ in range(7)) < 0.8 * min(seconds(slow) for _ in range(7))


def test_leaked_spans_are_cut_out_and_the_rest_stays(spark):
    words = [f"word{chr(97 + i % 26)}{i}" for i in range(60)]
    passage = " ".join(words)
    before, after = "Préambule — the court “sat” at noon. ", " Ends here; costs follow."
    leaked = passage.replace("wordb1 ", "wordb1\n*** PAGE 12 ***\n").upper()
    items = spark.createDataFrame([(1, passage), (2, "short one")], "item_id long, passage string")
    rows = [(1, before + leaked + after), (2, before + after), (3, None), (4, ""), (5, passage[:60]), (6, leaked + " " + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [(s.begin, s.end) for s in r.spans] for r in leak.leaked_spans(docs, items).collect()}
    assert set(spans) == {1, 6} and spans[1][0] == (len(before), len(before) + len(leaked))
    cleaned = {r.doc_id: r.text for r in leak.without_spans(docs, items).collect()}
    assert cleaned == {1: before + " " + after, 2: before + after, 3: None, 4: "", 5: passage[:60], 6: cleaned[6]} and "WORD" not in cleaned[6].upper()
    assert {r.doc_id for r in leak.without_leaks(docs, items).collect()} == {2, 3, 4, 5}


def test_blocks_of_passages_give_what_one_block_gives(spark, monkeypatch):
    passages = [(i, " ".join(f"p{i}w{j}x{(i * 7 + j * 13) % 97}" for j in range(30))) for i in range(9)]
    items = spark.createDataFrame(passages, "item_id long, passage string")
    docs = spark.createDataFrame([(i, "so " + p + " it is") for i, p in passages] + [(99, "nothing")], "doc_id long, text string")
    whole = sorted(map(tuple, leak.leaks(docs, items).collect()))
    monkeypatch.setattr(leak, "BLOCK_CHARACTERS", 500)
    assert sorted(map(tuple, leak.leaks(docs, items).collect())) == whole and len(whole) == 9
    assert [r.doc_id for r in leak.without_leaks(docs, items).collect()] == [99]


@pytest.mark.parametrize("alphabet", ["ab", "a", "=-", "éà日本", "the cat "])
def test_ids_are_emitted_before_a_long_piece_ends(alphabet):
    import random

    random.seed(5)
    piece = "".join(random.choice(alphabet) for _ in range(3000)).encode()
    machine = Transducer(parse_ranks(open(f"{encode.FOLDER}/byte_bpe_50k.tiktoken", "rb").read()))
    read = 0

    def bytes_of():
        nonlocal read
        for b in piece:
            read += 1
            yield b

    first, *rest = machine.emitted(bytes_of())
    ids = [first, *rest]
    assert b"".join(machine.token[i] for i in ids) == piece and tuple(ids) == machine.encode(piece)
    read = 0
    next(machine.emitted(bytes_of()))
    assert read < len(piece)
