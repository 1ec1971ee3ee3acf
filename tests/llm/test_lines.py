import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import jaccard, lineedit, linehash
from lectern.llm.common import mix
from lectern.llm.queries import QUERIES
from tests.llm.helpers import docs_of, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abc", max_size=14), st.text(alphabet="abc", max_size=14), st.integers(1, 3))
def test_banded_distance(a, b, edits):
    assert lineedit.within(a, b, edits) == (distance(a, b) <= edits)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcd", min_size=6, max_size=24), st.lists(st.tuples(
    st.sampled_from("ids"), st.integers(0, 30), st.sampled_from("abcd")), max_size=2), st.integers(1, 3))
def test_every_near_pair_shares_a_key(line, changes, edits):
    other = list(line)
    for kind, place, character in changes[:edits]:
        place %= len(other) + 1
        if kind == "i":
            other.insert(place, character)
        elif other and place < len(other):
            other[place:place + 1] = [character] if kind == "s" else []
    other = "".join(other)
    if min(len(line), len(other)) <= edits or line == other:
        return
    own, probed = [set(), set()], [set(), set()]
    for token, which, is_own in lineedit.keys_of([line, other], edits):
        for key, at in zip(token.tolist(), which.tolist()):
            probed[at].add(key)
            if is_own:
                own[at].add(key)
    assert own[0] & probed[1] or own[1] & probed[0]


@pytest.mark.parametrize("longest", [300, 70_000])
def test_counted_and_hashed_characters(longest):
    """Running sums of several counts at once, and hashes looked up, against one character at a time."""
    draw = random.Random(longest)
    letters = "ab é\uffff\U00010000\U0001f600"
    lines = ["".join(draw.choices(letters, k=k)) for k in (1, 2, 255, 256, 257, longest)] + ["a" * longest]
    codes = lineedit.code_points(lines)
    lengths = np.array([len(line) for line in lines])
    assert (lineedit.mixed(codes + np.uint32(1)) == mix(codes.astype(np.uint64) + np.uint64(1))).all()
    found = np.ascontiguousarray(lineedit.char_counts(codes, np.cumsum(lengths) - lengths, lengths)).view(np.uint8).reshape(-1, 8)
    for line, counts in zip(lines, found.tolist()):
        buckets = [int(mix(np.array([ord(c)], dtype=np.uint64))[0]) & 7 for c in line]
        assert counts == [buckets.count(bucket) % 256 for bucket in range(8)]


def changed(line, seed, edits):
    draw, made = random.Random(seed), list(line)
    for _ in range(edits):
        place = draw.randrange(len(made))
        kind = draw.randrange(3)
        made[place:place + 1] = [] if kind == 0 else ["#"] if kind == 1 else [made[place], "#"]
    return "".join(made)


@pytest.fixture(scope="module")
def rows():
    base = [prose(k, 9) for k in range(6)]
    made = [(k, "\n".join([prose(40 + k, 10), base[k % 6], "short"])) for k in range(12)]
    made += [(100 + k, changed(base[k % 6], k, 1 + k % 4) + "\n" + prose(70 + k, 8)) for k in range(40)]
    made += [(200, "  " + base[0] + " \n\n" + base[0] + "\n" + base[1]), (201, base[2] + "\n"), (202, ""), (203, None),
             (None, base[3] + "\n" + "own line of a row without an id, long enough"), (3, made[3][1]), (3, base[4]),
             (204, "y" * 3000), (205, "y" * 2999 + "z"), (206, "é" * 50), (207, "é" * 49 + "è"), (208, base[0].upper())]
    return made


def brute_edit(rows, least, edits):
    units = []
    texts = sorted({(doc, text or "") for doc, text in rows}, key=repr)
    for doc, text in texts:
        at = 0
        for number, whole in enumerate(text.split("\n")):
            line = whole.strip(" \t\n\x0b\x0c\r")
            if len(line) >= least:
                units.append(((doc is None, doc or 0, linehash.digest(text), number), (doc, text), (at, at + len(whole)), line))
            at += len(whole) + 1
    units.sort(key=lambda unit: unit[0])
    first = {}
    for unit in units:
        first.setdefault(unit[3], unit[0])
    lines = list(first)
    near = {b for k, b in enumerate(lines) for a in lines[:k]
            if (most := min(edits, min(len(a), len(b)) * edits // 40)) and abs(len(a) - len(b)) <= most and lineedit.within(a, b, most)}
    gone = {key: [] for key in texts}
    for place, key, span, line in units:
        if line in near or first[line] < place:
            gone[key].append(span)
    return gone


def kept_digest(text, spans):
    at, kept = 0, []
    for whole in text.split("\n"):
        if (at, at + len(whole)) not in spans:
            kept.append(whole)
        at += len(whole) + 1
    return hashlib.sha256("\n".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("small", [False, True])
def test_edit_dedup_against_all_pairs(spark, rows, small, monkeypatch):
    if small:
        monkeypatch.setattr(lineedit, "TILE_ROWS", 3)
        monkeypatch.setattr(lineedit, "BROADCAST_ROWS", 0)
    docs = docs_of(spark, rows).selectExpr("*", "1 as key", "2 as line")
    found = sorted(((r.doc_id, r.n_removed, r.removed, r.kept_sha256) for r in lineedit.dedup(docs).collect()), key=repr)
    gone = brute_edit(rows, lineedit.LEAST_CHARS, lineedit.EDITS)
    assert any(len(spans) for spans in gone.values())
    expected = []
    for doc, text in rows:
        spans = sorted(gone[(doc, text or "")])
        expected.append((doc, len(spans), ",".join(f"{a}:{b}" for a, b in spans), kept_digest(text or "", spans)))
    assert found == sorted(expected, key=repr)


def test_the_registered_setting_against_all_pairs(spark, rows, tmp_path):
    draw = random.Random(4)
    short = ["".join(draw.choices("ab c", k=draw.randrange(0, 60))) for _ in range(60)]
    more = rows + [(1000 + k, "\n".join(draw.choice([x, x[1:], x + "a", "z" + x[1:]]) for x in draw.choices(short, k=5))) for k in range(60)]
    docs_of(spark, more).write.parquet(f"{tmp_path}/documents.parquet")
    gone = brute_edit(more, 1, lineedit.EDITS)
    found = sorted(((r.doc_id, r.removed) for r in QUERIES["op6_line_edit_dedup"](spark, str(tmp_path)).collect()), key=repr)
    assert found == sorted(((doc, ",".join(f"{a}:{b}" for a, b in sorted(gone[(doc, text or "")]))) for doc, text in more), key=repr)


def test_clashing_names(spark, rows):
    docs = docs_of(spark, rows[:40]).selectExpr("*", "1 as _key", "2 as _doc", "3 as _OF", "4 as _spans", "5 as _class", "6 as _id", "7 as _keep")
    plain = {r.doc_id: r.text for r in lineedit.clean(docs_of(spark, rows[:40])).collect()}
    cleaned = lineedit.clean(docs)
    assert cleaned.columns == docs.columns and {r.doc_id: r.text for r in cleaned.collect()} == plain
    assert jaccard.keep_one(docs).columns == docs.columns
    assert jaccard.keep_one(docs).count() == jaccard.keep_one(docs_of(spark, rows[:40])).count()


def test_short_lines_go(spark, tmp_path):
    """Equal lines of any length; from 20 characters on one edit, from 40 on two."""
    line = "abcdefghijklmnopqrstuvwxyz"
    rows = [(1, f"ok\n\n{line}\nnineteen characters\n版权所有\n{line * 2}"),
            (2, "OK\n\nok\nnineteen character\n版权所有\n \nx"), (3, f"#{line}\n##{line}#\nx\n{line * 2}##\nown")]
    found = {r.doc_id: r.text for r in lineedit.clean(docs_of(spark, rows), least=1).collect()}
    assert found == {1: rows[0][1], 2: "OK\n\nnineteen character\n \nx", 3: f"##{line}#\nown"}
    floor = {r.doc_id: r.text for r in lineedit.clean(docs_of(spark, rows), least=40).collect()}
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    listed = {r.doc_id: r.n_removed for r in QUERIES["op6_line_edit_dedup"](spark, str(tmp_path)).collect()}
    assert listed == {1: 0, 2: 2, 3: 3}
    assert floor == {1: rows[0][1], 2: rows[1][1], 3: f"#{line}\n##{line}#\nx\nown"}


def test_clean_keeps_columns(spark, rows):
    docs = docs_of(spark, rows)
    cleaned = lineedit.clean(docs)
    assert cleaned.schema == docs.schema and cleaned.count() == docs.count()
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts[203] is None and texts[202] == "" and texts[206] == "é" * 50 and texts[207] == ""


def test_hash_dedup_offsets_and_rank(spark):
    line = "one two three four five six seven eight"
    rows = [(2, line + "\nshort line\n" + line.upper()), (1, "x\n  ONE two  three four five six seven eight\t\ny"), (None, line),
            (3, None), (4, ""), (2, line + "\nshort line\n" + line.upper())]
    docs = docs_of(spark, rows).selectExpr("*", "1 as unit", "2 as start")
    found = sorted(((r.doc_id, r.n_units, r.removed, r.kept_sha256) for r in linehash.dedup(docs).collect()), key=repr)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    twice = (2, 3, f"0:{len(line)},{len(line) + 12}:{2 * len(line) + 12}", sha("short line"))
    assert found == sorted([
        (1, 3, "", sha(rows[1][1])), twice, twice, (None, 1, f"0:{len(line)}", sha("")), (3, 1, "", sha("")),
        (4, 1, "", sha(""))], key=repr)
    assert linehash.dedup(docs.limit(0)).count() == 0 and lineedit.dedup(docs.limit(0)).count() == 0


@given(st.text(alphabet="ab\n", max_size=20), st.sets(st.integers(0, 20)))
def test_drop_spans_is_joining_the_other_lines(text, chosen):
    at, spans, kept = 0, [], []
    for number, line in enumerate(text.split("\n")):
        if number in chosen:
            spans.append((at, at + len(line)))
        else:
            kept.append(line)
        at += len(line) + 1
    assert linehash.drop_spans(text, spans) == "\n".join(kept)
