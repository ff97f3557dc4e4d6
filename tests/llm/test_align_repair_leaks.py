"""Cross-tokenizer alignment, conversation repair and benchmark decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from staylytics.llm import multi_pattern, token_align, turn_repair
from staylytics.llm.queries import TOKENIZERS

# --- alignment


@pytest.fixture(scope="module")
def files():
    return token_align.Files.read(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def whole(encoder, text):
    """Ids of a whole text by both libraries, without cutting it; none where the bytes differ."""
    if not text:
        return [], []
    a, b = encoder.a.encode(" " + text, add_special_tokens=False).ids, encoder.b.encode(text)
    data = (" " + text).encode()
    same = b"".join(encoder.a_bytes[i] for i in a) == data == b"".join(encoder.b_bytes[i] for i in b)
    return (a, b) if same else ([], [])


def brute_report(encoder, rows):
    each, counts = [], Counter()
    for _, text in rows:
        a, b = whole(encoder, text)
        ends = {int(e): j for j, e in enumerate(np.cumsum([len(encoder.b_bytes[i]) for i in b]))}
        cuts = [(i, ends[int(e)]) for i, e in enumerate(np.cumsum([len(encoder.a_bytes[i]) for i in a])) if int(e) in ends]
        links = [(a[i], b[j]) for i, j in cuts]
        counts.update(links)
        groups, x, y = [], 0, 0
        for i, j in cuts:
            groups.append(",".join(map(str, a[x : i + 1])) + "|" + ",".join(map(str, b[y : j + 1])))
            x, y = i + 1, j + 1
        each.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((
        (doc, n_a, n_b, len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "")
        for (doc, _), (n_a, n_b, g, links) in zip(rows, each)), key=repr)


ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b\n\n c\t", "x\n y", "it's 'll <|endoftext|> <s> <unk> <0x41>", "a▁b c", "naïve café 𠀀  x　y",
    "\x00\x01", "é", "a\r\nb  \r\n", "don't  stop   now    ", "ab" * 3000, " " * 5000 + "x", "word " * 4000, "﻿bom", "12345 67.89", "same text here", "same text here",
]


def test_alignment_equals_brute_force_on_odd_texts(spark, files):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no name"), (3, "again " * 7)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, a_ids string, code int")
    got = token_align.link_report(docs, files).collect()
    want = brute_report(token_align.Encoder(files), rows)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert {r["groups_sha256"] for r in got if not r["n_a"]} == {""}


def test_alignment_in_several_slices_and_small_pieces(spark, files, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_report(token_align.Encoder(files), rows)
    assert sorted((tuple(r) for r in token_align.link_report(docs, files).collect()), key=repr) == want
    monkeypatch.setattr(token_align, "SLICE_PAIRS", 500)
    assert sorted((tuple(r) for r in token_align.link_report(docs, files).collect()), key=repr) == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.link_report(empty, files).collect() == [] == token_align.align(empty, files).collect()


def test_stretches_and_forgetting_do_not_change_ids(files, monkeypatch):
    encoder = token_align.Encoder(files)
    assert encoder.apart and encoder.ranked
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "'s", "12", "!", "\t", "ç", "<s>", " und"]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    monkeypatch.setattr(token_align, "TABLE_WORDS", 50)
    for lo in range(0, 400, 40):
        (a, a_rows), (b, b_rows) = encoder.encode(texts[lo : lo + 40])
        for k, text in enumerate(texts[lo : lo + 40]):
            assert (a[a_rows[k] : a_rows[k + 1]].tolist(), b[b_rows[k] : b_rows[k + 1]].tolist()) == whole(encoder, text)


@pytest.mark.parametrize("seed", range(40))
def test_shared_cuts(seed):
    rng = np.random.default_rng(seed)
    a_ends, b_ends, a_rows, b_rows, base = [], [], [0], [0], 0
    for _ in range(int(rng.integers(0, 6))):
        size = int(rng.integers(0, 200))
        for ends, rows in ((a_ends, a_rows), (b_ends, b_rows)):
            inner = rng.choice(np.arange(1, size), int(rng.integers(0, size)), replace=False) if size > 1 else []
            ends += sorted({base + int(x) for x in inner} | ({base + size} if size else set()))
            rows.append(len(ends))
        base += size
    a_ends, b_ends = np.array(a_ends, np.int64), np.array(b_ends, np.int64)
    cut_a, cut_b = token_align.shared_cuts(a_ends, b_ends, np.array(a_rows), np.array(b_rows))
    both, want_a, want_b = np.intersect1d(a_ends, b_ends, return_indices=True)
    assert cut_a.tolist() == want_a.tolist() and cut_b.tolist() == want_b.tolist()


def test_align_returns_groups(spark, files):
    row = token_align.align(spark.createDataFrame([(1, "Übergang is tokenized")], "doc_id long, text string"), files).first()
    assert row["a_cuts"][-1] == len(row["a_ids"]) and row["b_cuts"][-1] == len(row["b_ids"]) and len(row["a_cuts"]) == len(row["b_cuts"])


# --- repair


def brute_repair(rows):
    """Cheapest (cost, audit) by trying all edits; prefixes of equal state keep the least."""
    def inserted(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                to = 3 if state == 2 else 2
                best[to] = min(best.get(to, (cost + 6, "")), (cost + 5, audit + "I"))
        return best

    best = {0: (0, "")}
    for role, fault in rows:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            options = [(2, "D", state)]
            to, stays = (3 if state == 2 else 2), 5 * (fault == "truncated")
            if fault in ("", "truncated"):
                options.append((1 + stays, "R", to))
                if role[:1] == ("a" if state == 2 else "u"):
                    options.append((stays, "K", to))
                if role[:1] == "s" and state == 0:
                    options.append((stays, "K", 1))
            for more, mark, to in options:
                after[to] = min(after.get(to, (cost + more + 1, "")), (cost + more, audit + mark))
        best = after
    best = inserted(best)
    return min(best[s] for s in (0, 3) if s in best)


@pytest.mark.parametrize("segment", [32, 5, 1])
def test_search_equals_brute_force(segment, monkeypatch):
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(1500):
        n = rng.choice([0, 1, 2, 3, 5, 9, 25, 70])
        pairs = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["", "", "", "blank", "truncated", "duplicate"])) for _ in range(n)]
        now, out = turn_repair._Conversation(1), []
        for i, (role, fault) in enumerate(pairs):
            now.add(i, turn_repair.Row(role, str(i), fault))
            if len(now.pending) - now.done >= segment:
                out += now.advance(False)
        out += now.advance(True)
        assert (now.summary()["cost"], "".join(x.edit for x in out)) == brute_repair(pairs)
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in out if x.edit != "D"))


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        rows_ = out.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows_ += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_conversations(rows):
    out = []
    for conv, turns in brute_damage(rows).items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = brute_repair([(r, f) for (_, r, _), f in zip(turns, faults)])
        lines, state, queue = [], 0, list(turns)
        for edit in audit:
            row = None if edit == "I" else queue.pop(0)
            if edit != "D":
                to = 1 if edit == "K" and row[1][0] == "s" else 3 if state == 2 else 2
                lines.append((row[1] if edit == "K" else {2: "user", 3: "assistant"}[to]) + ":" + (row[2] if row else ""))
                state = to
        n = sorted({t for t, _, _ in turns if t is not None})
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        out.append((conv, n[-1] - n[0] + 1 - len(n) if n else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repair_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "tool", ""]), rng.choice(["Yes.", "Why?", "no", "", " \n", None, "ok!  ", "ok. "]))
            for c in [*range(60), None] for t in rng.sample([*range(12), None, None, 4], rng.randint(1, 12))]
    rows += [(1000, t, "user" if t % 2 else "assistant", "x" * 5000 + ".") for t in range(700)] + rows[:30]
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, place int")
    damaged = turn_repair.damage(frame)
    assert sorted((tuple(r) for r in turn_repair.repair_report(damaged).collect()), key=repr) == brute_conversations(rows)
    turns = {}
    for r in turn_repair.repaired_turns(damaged).collect():
        if r["place"] is not None:
            turns.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for conv, *_, digest in brute_conversations(rows):
        lines = [x for _, x in sorted(turns.get(conv, []))]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == digest
    assert turn_repair.repair_report(turn_repair.damage(frame.limit(0))).collect() == []


def test_a_long_conversation_is_not_held(monkeypatch):
    held = 0
    now = turn_repair._Conversation(1)
    rng = random.Random(9)
    for i in range(5000):
        now.add(i, turn_repair.Row(rng.choice(["user", "assistant"]), "t", rng.choice(["", "", "blank", "truncated"])))
        if len(now.pending) - now.done >= turn_repair.SEGMENT:
            list(now.advance(False))
        held = max(held, len(now.pending))
    assert held < 4 * turn_repair.SEGMENT


# --- decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_leaks(docs, items, width=10):
    out, grams = [], {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            grams.setdefault(tuple(w[i : i + width]), set()).add(name)
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i : i + k])) in grams:
                    hit.update(range(i, i + k))
                    met |= grams[g]
        met.discard(None)
        names = ",".join(sorted(map(str, met)))
        out.append((doc, len(w), len(hit), len(met), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def leak_case(seed):
    rng = random.Random(seed)
    text = lambda n, k: " ".join(rng.choice([f"w{rng.randrange(k)}", f"Ä{rng.randrange(k)}", "a", "the"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 9, 10, 11, 30, 60]), 400)) for i in range(60)]
    items += [(70, None), (71, ""), (72, " .,- "), (None, text(12, 400)), (5, text(14, 400)), (80, items[3][1]), (81, "x " * 40), (82, items[8][1].upper())]
    docs = [(1, None), (2, ""), (3, "..."), (4, "x " * 3000), (None, text(30, 50)), (5, "z"), (5, "z")]
    for i in range(80):
        parts = [text(rng.randint(0, 40), 400)]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            lo = rng.randint(0, max(0, len(w) - 5))
            parts += [rng.choice([" ", "--", "\n\n"]).join(w[lo : lo + rng.randint(5, 40)]), text(rng.randint(0, 30), 400)]
        docs.append((100 + i, rng.choice([" ", ". ", "\t"]).join(parts)))
    return docs + [(900, " ".join((t or "") for _, t in docs) * 3)], items


@pytest.mark.parametrize("seed,block", [(1, 1 << 30), (2, 1 << 30), (3, 4000)])
def test_leaks_equal_brute_force(spark, seed, block, monkeypatch):
    docs, items = leak_case(seed)
    frame = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, spans int, key string")
    other = spark.createDataFrame([(*d, "k") for d in items], "item_id long, text string, window string")
    got = multi_pattern.leak_report(frame, other, block_bytes=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_leaks(docs, items)


def test_leaks_with_empty_tables(spark):
    docs, items = leak_case(4)
    frame, other = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert multi_pattern.leak_report(frame.limit(0), other).collect() == []
    assert sorted((tuple(r) for r in multi_pattern.leak_report(frame, other.limit(0)).collect()), key=repr) == brute_leaks(docs, [])


def test_searcher_lanes_and_shifts(monkeypatch):
    monkeypatch.setattr(multi_pattern, "LANE", 7)
    rng = random.Random(2)
    for _ in range(60):
        text = " " + " ".join(rng.choice(["a", "b", "ab", "abc", "é"]) for _ in range(rng.randint(1, 60))) + " "
        tokens = text.split()
        strings = sorted({(" " + " ".join(tokens[i : i + rng.randint(1, 12)]) + " ").encode() for i in range(len(tokens))})
        data = text.encode()
        found = sorted((a, p) for a, _, p in multi_pattern.Searcher(strings, [()] * len(strings)).find(np.frombuffer(data, np.uint8)))
        assert found == sorted((a, p) for p, s in enumerate(strings) for a in range(len(data)) if data.startswith(s, a))
