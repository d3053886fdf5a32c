"""Turn alignment, Orchard clusters and the merge automaton against brute force and the library."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from feedlake.llm import merge_automaton, orchard, turn_alignment
from feedlake.llm.queries import QUERIES

WORDS = P.path("word_bpe_49k.json")


# ---- op11 -----------------------------------------------------------------------------------------------


def all_audits(codes):
    """(least cost, least audit) by trying every edit of every turn, with insertions anywhere."""
    best = None

    def ok(out):
        return re.fullmatch("(s?(ua)+)?", out)

    def go(i, out, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(codes) and ok(out):
            best = min(best, (cost, audit)) if best else (cost, audit)
        if len(out) > len(codes) + 3:
            return
        if i < len(codes):
            code = codes[i]
            go(i + 1, out, cost + 3, audit + "D")
            if code != "x":
                cut = code != code.lower()
                go(i + 1, out + code.lower(), cost + cut, audit + "K")
                for role in "ua":
                    if role != code:
                        go(i + 1, out + role, cost + 2 + cut, audit + "R")
        for role in "ua":
            if re.fullmatch("s?(ua)*u?", out + role):
                go(i, out + role, cost + 2, audit + "I")

    best = (3 * len(codes), "D" * len(codes))
    go(0, "", 0, "")
    return best


def test_audits_equal_all_tries():
    assert turn_alignment.align("") == (0, "")
    for n in range(1, 4):
        for codes in map("".join, itertools.product("suaoAx" if n == 3 else "suaoSUAx", repeat=n)):
            want = all_audits(codes)
            assert turn_alignment.banded(codes) == want == turn_alignment.folded(codes), codes
    r = random.Random(1)
    for _ in range(40):
        codes = "".join(r.choice("suauaUAxo") for _ in range(r.randint(4, 5)))
        assert turn_alignment.banded(codes) == all_audits(codes) == turn_alignment.folded(codes), codes


def test_banded_and_folded_tables_agree_on_long_conversations():
    r = random.Random(2)
    for n in (7, 15, 40, 120, 400):
        for _ in range(12):
            codes = "".join(r.choice("suauauauauaUAxo") for _ in range(n))
            assert turn_alignment.banded(codes) == turn_alignment.folded(codes), codes
    cost, audit = turn_alignment.align("ua" * 20_000 + "x" + "u" * 9)
    assert cost == 3 + 5 * 2 and audit.startswith("K" * 40_000)


def brute_conversation(rows):
    """The contract on one conversation's rows (turn, role, text), by the brute-force audit."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    codes, seen, n = "", set(), [0, 0, 0]
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        code = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not body:
            n[0], code = n[0] + 1, "x"
        elif (role, text) in seen:
            n[1], code = n[1] + 1, "x"
        elif body[-1] not in ".!?":
            n[2], code = n[2] + 1, code.upper()
        seen.add((role, text))
        codes += code
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = all_audits(codes) if len(codes) < 5 else turn_alignment.folded(codes)
    out, kept, want = [], iter(rows), 0
    for edit in audit:
        row = None if edit == "I" else next(kept)
        if edit == "D":
            continue
        if edit == "K" and row[1][:1] == "s":
            out.append(f"{row[1]}:{row[2]}")
            continue
        name = row[1] if edit == "K" else ("user", "assistant")[want]
        out.append(f"{name}:{row[2] if row else ''}")
        want = 1 - want
    return (gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def conversation_rows():
    r, rows = random.Random(4), []
    for conv in [*range(150), None]:
        for turn in range(r.randint(1, 6)):
            text = r.choice(["Yes.", "No", "", " \t", None, "What?\n", "é!", "Yes.", "x" * 3000 + "."])
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, None]), r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), text))
    rows += rows[:40]  # repeated rows
    rows += [(1000, k, "ua"[k % 2] + "ser", f"turn {k}.") for k in range(700)] + [(1001, 5, "user", "Hi.")] * 300
    return rows


CHAT = "conv_id bigint, turn bigint, role string, text string, id string, kind int, audit string"


def as_chat(spark, rows):
    return spark.createDataFrame([(*r, "i", 9, "z") for r in rows], CHAT).repartition(5)


def test_conversations_equal_brute_force(spark):
    rows = conversation_rows()
    table = as_chat(spark, rows)
    harmed = turn_alignment.damaged(table)
    assert sorted(map(tuple, harmed.collect()), key=repr) == sorted(brute_damage(rows), key=repr)
    got = {r.conv_id: tuple(r)[1:] for r in turn_alignment.repair_summary(harmed, ids=table).collect()}
    by_conv = {conv: [] for conv, *_ in rows}
    for conv, *row in brute_damage(rows):
        by_conv[conv].append(tuple(row))
    assert got == {conv: brute_conversation(turns) for conv, turns in by_conv.items()}
    assert any(not turns for turns in by_conv.values())  # a conversation that lost every row is reported
    steps = turn_alignment.repaired_turns(harmed).where("edit <> 'D'").collect()
    spoken = {}
    for r in sorted(steps, key=lambda r: r.step):
        spoken.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    digests = {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in spoken.items()}
    assert digests == {c: v[-1] for c, v in got.items() if v[-1] != hashlib.sha256(b"").hexdigest()}


def test_conversations_of_an_empty_table(spark):
    none = spark.createDataFrame([], CHAT)
    assert turn_alignment.repair_summary(turn_alignment.damaged(none), ids=none).count() == 0
    assert turn_alignment.repaired_turns(none).count() == 0


def test_op11_reports_every_conversation_of_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by_conv = {conv: [] for conv, *_ in rows}
    for conv, *row in brute_damage(rows):
        by_conv[conv].append(tuple(row))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_turn_alignment"](spark, sf).collect()}
    assert got == {conv: brute_conversation(turns) for conv, turns in by_conv.items()}


# ---- op12 -----------------------------------------------------------------------------------------------


def brute_clusters(vectors, k, rounds, size, salt):
    """{(id, vector): (cluster, distance, cluster inertia, inertia, digest)} by measuring every centroid, in Python integers."""
    kept = [(i, tuple(int(np.floor(1024 * float(x))) for x in v)) for i, v in vectors
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{salt}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, g in groups.items():
            centroids[n] = tuple(sum(c) // len(g) for c in zip(*g))
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = {n: sum(d for _, m, d in found if m == n) for _, n, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, n, d in found), key=repr)


def vector_rows():
    r, rows = random.Random(6), []
    for i in range(400):
        centre = r.choice([-3.0, -1.0, 0.0, 0.5, 4.0])
        rows.append((i, [centre + r.choice([-0.25, 0.0, 0.25, r.random()]) for _ in range(5)]))
    rows += [(1, rows[1][1]), (None, rows[2][1]), (None, [0.0] * 5), (900, None), (901, []), (902, [1.0] * 4)]
    rows += [(903, [1.0] * 6), (904, [None] + [1.0] * 4), (905, [float("nan")] * 5), (906, [float("-inf")] + [0.0] * 4)]
    rows += [(910 + k, [1.0, -1.0, 0.0, 0.0, 0.0]) for k in range(150)]  # one very common vector
    rows += [(1100 + k, [float(k % 3 - 1), 0.0, 0.0, 0.0, 0.0]) for k in range(30)]  # ties
    return rows


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 1), (1, 4), (40, 6), (2000, 2)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], "vec_id bigint, embedding array<float>, id int, v int, cluster string").repartition(4)
    got = orchard.centroid_clusters(table, k, rounds, 5)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, k, rounds, 5, "3")


def test_orchard_measures_fewer_centroids_and_finds_the_nearest():
    r = np.random.default_rng(3)
    centroids = r.integers(-4000, 4000, (60, 8))
    centroids[7] = centroids[31]
    x = np.concatenate([centroids[r.integers(0, 60, 3000)] + r.integers(-40, 40, (3000, 8)), centroids])
    order, apart = orchard.neighbour_lists(centroids)
    cluster, distance = orchard.orchard_search(x, centroids, order, apart)
    all_d = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == all_d.argmin(axis=1)).all() and (distance == all_d.min(axis=1)).all()


def test_clusters_of_an_empty_table_and_of_too_large_values(spark):
    schema = "vec_id bigint, embedding array<double>"
    none = orchard.centroid_clusters(spark.createDataFrame([], schema))
    assert none.count() == 0 and none.columns == orchard.centroid_clusters(spark.createDataFrame([(1, [0.5] * 64)], schema)).columns
    with pytest.raises(Exception, match="beyond"):
        orchard.centroid_clusters(spark.createDataFrame([(1, [1e30] * 64)], schema)).collect()


def test_op12_equals_brute_force_on_the_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op12_orchard_clusters"](spark, sf)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, 8, 10, 64, "3")


# ---- op13 -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORDS)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def automaton():
    return merge_automaton.MergeAutomaton(open(WORDS, "rb").read())


def test_automaton_equals_the_library_on_random_texts(library, automaton):
    r = random.Random(3)
    parts = [" ", "  ", "\n", "\x1c", "\x85", " ", "　", "a", "foo", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "12", "é", "é", "日本", "!?",
             "x" * 300, "ab" * 40, "=====", "aaa", "ΑΣ", "Σ", "İ", "ß", "ẞ", "՘", "Ɤ", "한국", "</w>", "<", "/w>", "Ǆ", "ﬁ", "😀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    texts += ["".join(r.choice("abcdefgeinrst'é") for _ in range(r.randint(1, 20))) for _ in range(6000)]
    texts += ["a" * k for k in range(1, 70)] + ["ab" * 60_000, "ü" * 50_000, "the " * 20_000]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert automaton.encode(t) == ids, t[:100]
        assert automaton.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert automaton.encode(None) == [] and automaton.decode([]) == ""


def test_automaton_equals_the_library_on_every_character(library, automaton):
    for c in itertools.chain(range(0xD800), range(0xE000, 0x110000)):
        if c < 0x3400 or c % 97 == 0 or 0xA000 <= c < 0xB000 or 0xF900 <= c < 0x11000:
            t = f"A{chr(c)}1 b{chr(c)}"
            assert automaton.encode(t) == library.encode(t, add_special_tokens=False).ids, hex(c)


def test_arcs_are_the_pairs_the_merges_leave_alone(library, automaton):
    """Label y may follow label x exactly if the merges turn the text of both into x, y again (y ends the word)."""
    r = random.Random(8)
    suffix = [t for t in automaton.left if automaton.labels[t].endswith("</w>")]
    middle = [t for t in automaton.left if not automaton.labels[t].endswith("</w>") and automaton.labels[t].isascii() and automaton.labels[t].islower()]
    suffix = [t for t in suffix if automaton.labels[t][:-4].isascii() and automaton.labels[t][:-4].isalpha() and automaton.labels[t].islower()]
    for _ in range(3000):
        x, y = r.choice(middle), r.choice(suffix)
        text = automaton.labels[x] + automaton.labels[y][:-4]
        assert automaton.arc(x, y) == (library.encode(text, add_special_tokens=False).ids == [x, y])


def test_round_trip_query(spark, library):
    texts = [None, "", " \n", "Hello, World's 42!", "Hello, World's 42!", "<|endoftext|>É", "x" * 100_000, "un " * 5000]
    rows = [(k, t, "e", 1) for k, t in enumerate(texts)] + [(None, "null id", "e", 1), (3, texts[3], "e", 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int").repartition(3)
    want = []
    for k, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, merge_automaton.round_trip_digests(table, WORDS).collect()), key=repr) == sorted(want, key=repr)
    coded = merge_automaton.encode_words(table, WORDS, keep=("doc_id", "text"))
    back = merge_automaton.decode_words(coded, WORDS, keep=("doc_id", "text"))
    for r in back.collect():
        assert r.decoded == library.decode(library.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False)
    empty = spark.createDataFrame([], table.schema)
    assert merge_automaton.round_trip_digests(empty, WORDS).count() == 0
