"""Repeated passages of over fifty words that take few bytes."""

import collections
import re

import numpy as np
import pytest
from fixtures_llm import package  # noqa: F401

import corpus_pipeline as P
from landfall.llm import queries, suffix


def brute(rows):
    """(doc_id, text that stays) of the stage, by strings of REPEAT_BYTES and passages of 51 words in places that don't overlap."""
    found = []
    for d, t in rows:
        raw = (t or "").encode()
        words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        spans = [(a, b, "w") for (a, _), (_, b) in zip(words, words[50:])]
        spans += [(i, i + P.REPEAT_BYTES, "b") for i in range(len(raw) - P.REPEAT_BYTES + 1)]
        found.append((d, raw, spans))
    places = collections.defaultdict(list)
    for k, (_, raw, spans) in enumerate(found):
        for a, b, kind in spans:
            places[kind, raw[a:b]].append((k, a))
    again = {x for x, at in places.items() if len(at) > 1 and (
        x[0] == "b" or at[0][0] != at[-1][0] or at[-1][1] - at[0][1] >= len(x[1]))}
    out = []
    for d, raw, spans in found:
        stay = np.ones(len(raw), bool)
        for a, b, kind in spans:
            if (kind, raw[a:b]) in again:
                stay[a:b] = False
        kept = bytes(np.frombuffer(raw, np.uint8)[stay]).decode("utf-8", "ignore")
        if stay.all() or kept.strip():
            out.append((d, kept))
    return sorted(out, key=repr)


def test_passages_of_short_words_are_cut(spark):
    rng = np.random.default_rng(51)
    prose = lambda n, k=9: [f"{''.join(rng.choice(list('abcdefghij'), rng.integers(1, k)))}" for _ in range(n)]
    p, q, s = prose(51, 4), prose(50, 4), prose(70, 3)
    text = lambda *parts: " ".join(w for x in parts for w in x)
    assert len(text(p)) < P.REPEAT_BYTES and len(text(s[:51])) < P.REPEAT_BYTES
    rows = [
        (1, text(prose(40), p, prose(30))), (2, text(p, prose(60))), (3, text(prose(60), p)),   # inside, at the start, at the end
        (4, text(prose(40), q, ["end"])), (5, text(prose(30), q, ["other"])),                   # fifty words stay
        (6, text(prose(20), s, prose(20))), (7, text(prose(9), s[:60])), (8, text(s[10:], prose(9))),   # overlapping
        (9, text(p)),                                                                           # nothing else: goes
        (10, text(prose(5)) + "\n" + "\n".join(p)),                                             # other spacing stays
        (11, "x" + text(p, prose(3))),                                                          # other first word: fifty stay
        (12, text(prose(3), *[x for _ in range(2) for x in (prose(51, 4),)])),
        (13, " ".join(["a b"] * 60) + " é"), (14, "é " + text(prose(4), s[:51]) + " 漢字"),
        (20, "x " + " ".join(["the"] * 60) + " y"), (21, " ".join(["of"] * 55) + " y"), (22, "z " + " ".join(["of"] * 70)),
        (23, text(["twice"], p)), (23, text(["twice"], p)), (15, None), (16, ""), (None, text(prose(10), p)), (17, text(prose(2, 3))),
    ]
    r = prose(51, 4)
    rows += [(18, text(r, ["mid"], r)), (19, text(prose(600, 12), p, prose(600, 12)))]
    df = spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    out = P.suffix_dedup(spark, df, "").collect()
    assert sorted(((x["doc_id"], x["text"] or "") for x in out), key=repr) == brute(rows)
    assert all(x["n_chars"] == len(x["text"]) for x in out if x["text"] is not None)
    kept = {x["doc_id"]: x["text"] for x in out}
    assert 9 not in kept and kept[18].split() == ["mid"] and kept[21].split() == ["y"] and kept[20] == dict(rows)[20]


def passages(rows, words):
    """(doc_id, bytes, runs) covered by passages of ``words`` words whose words begin at another word too."""
    places, found = collections.Counter(), []
    for d, t in rows:
        raw = (t or "").encode()
        at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        said = [raw[a:b] for a, b in at]
        wins = [(tuple(said[i:i + words]), at[i][0], at[i + words - 1][1]) for i in range(len(at) - words + 1)]
        places.update(w for w, _, _ in wins)
        found.append((d, raw, wins))
    out = []
    for d, raw, wins in found:
        mask = np.zeros(len(raw), int)
        for w, a, b in wins:
            if places[w] > 1:
                mask[a:b] = 1
        out.append((d, int(mask.sum()), int((np.diff(mask, prepend=0) == 1).sum())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece, group", [(suffix.PIECE, suffix.GROUP), (300, 2)])
def test_passages_shorter_than_the_strings_are_reported(spark, tmp_path, monkeypatch, piece, group):
    """Passages of 51 words in fewer than 400 bytes show in op7's columns after the contract's; a small piece cuts long texts."""
    monkeypatch.setattr(suffix, "PIECE", piece)
    monkeypatch.setattr(suffix, "GROUP", group)
    rng = np.random.default_rng(7)
    prose = lambda n, k=9: ["".join(rng.choice(list("abcdefghij"), rng.integers(1, k))) for _ in range(n)]
    text = lambda *parts: " ".join(w for x in parts for w in x)
    p, q, s = prose(55, 6), prose(50, 6), prose(130)
    edit = lambda w, *at: [x if i not in at else "X" for i, x in enumerate(w)]
    assert len(text(p)) < 400
    rows = [
        (1, text(prose(40), p, prose(30))), (2, text(p, prose(60))), (3, text(prose(60), p)),   # inside, at the start, at the end
        (4, text(prose(40), q, ["end"])), (5, text(prose(30), q, ["other"])),                   # fifty words
        (6, "\n".join(prose(3) + p)), (7, text(prose(3), edit(p, 4))), (8, text(edit(p, 30))),  # other spacing, other words
        (9, text(s)), (10, text(edit(s, 60))), (11, text(edit(s, 0, 129), prose(9))), (12, text(s[:70], prose(5), s[60:])),
        (13, text(prose(60), ["the"] * 70, prose(5))), (14, "\u6f22\u5b57 " + text(p) + " \u00e9"), (15, None), (16, ""),
        (17, text(prose(51))), (18, "x" + text(p[1:], prose(3))), (None, text(prose(4), p)), (None, None),
        (20, text(prose(90))), (20, text(prose(30), q)), (21, text(r := prose(60))), (21, text(r)),
        (22, text(m := prose(52, 5), prose(400, 12), p, prose(400, 12), m)),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["op7_suffix_dedup"](spark, str(tmp_path)).collect()
    want = passages(rows, 51)
    assert sorted(((x["doc_id"], x["n_passage_bytes"], x["n_passages"]) for x in out), key=repr) == want
    assert {x["doc_id"] for x in out if x["n_passages"] and not x["n_removed"]} >= {1, 2, 3, 6, 14}
    assert {d for d, n, _ in want if not n} >= {4, 5, 7, 15, 16, 17, 20}
