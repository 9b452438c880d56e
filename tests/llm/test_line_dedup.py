import random
import time

from depthframe.llm import line_dedup as d
from tests.llm.fixtures import docs, prose

P = prose(1, 60)
Q, R = prose(2, 30), prose(3, 30)
OWN = [prose(50 + k, 12) for k in range(12)]


def run(spark, rows, **kw):
    return {(r.doc_id, r.source): r for r in d.drop_passages(docs(spark, rows, extra=True), **kw).collect()}


def test_later_copy_of_a_passage_goes(spark):
    rows = [(1, f"{OWN[0]}\n{P}\n{OWN[1]}"), (2, f"{OWN[2]}\n\n  {P}  \n{OWN[3]}"), (3, P), (4, f"{OWN[4]}\n{Q}\n{R}"), (5, f"{Q}\n{R}\n{OWN[5]}"), (6, f"{Q}\n{OWN[6]}\n{R}"), (7, f"{R}\n{OWN[7]}"), (8, None), (9, ""), (None, P)]
    out = {r.doc_id: r.text for r in d.drop_passages(docs(spark, rows, extra=True)).collect()}
    assert out == {
        1: rows[0][1],  # the first holder keeps it
        2: f"{OWN[2]}\n\n{OWN[3]}",
        3: "",
        4: rows[3][1],
        5: OWN[5],  # two lines of 30 words make one passage
        6: rows[5][1],  # apart they are too short
        7: rows[6][1],
        8: None,
        9: "",
        None: P,
    }


def test_equal_rows_and_ties(spark):
    rows = [(1, P), (2, f"{P}\n{OWN[0]}"), (2, f"{P}\n{OWN[0]}"), (2, f"{P}\n{OWN[1]}")]
    out = sorted(r.text for r in d.drop_passages(docs(spark, rows)).collect())
    assert out == sorted([P, OWN[0], OWN[0], OWN[1]])


def test_crossing_blocks_and_repeats():
    words = lambda lines: [len(x.split()) for x in lines]
    number = {}
    ids = lambda lines: [number.setdefault(x, len(number) + 2) for x in lines]
    first = [OWN[0], P, OWN[1], Q, R]
    later = [Q, R, OWN[0], OWN[1], P, P]  # moved, and once more
    blocks = d.aligned_blocks(ids(later), words(later), ids(first), 50)
    assert blocks == [(0, 2), (4, 5), (5, 6)]


def test_alignment_of_lines_in_any_order_takes_bounded_work():
    n = 20_000
    lines = list(range(2, n + 2))
    start = time.monotonic()
    assert d.aligned_blocks(lines[::-1], [60] * n, lines, 50) == [(k, k + 1) for k in range(n)]  # each line by itself is a passage
    assert d.aligned_blocks(lines[::-1], [20] * n, lines, 50) == []
    shuffled = lines[:]
    random.Random(4).shuffle(shuffled)
    assert len(d.aligned_blocks(shuffled, [60] * n, lines, 50)) == sum(b != a + 1 for a, b in zip([0, *shuffled], shuffled))
    assert d.aligned_blocks([7] * n, [60] * n, [7, 8], 50) == [(k, k + 1) for k in range(n)]  # one line of the earlier document, many times
    assert time.monotonic() - start < 40


def test_late_rounds_find_what_early_rounds_find(monkeypatch):
    rng = random.Random(6)
    for _ in range(40):
        first = rng.sample(range(2, 200), 60)
        later = [x for k in rng.sample(range(0, 60, 3), 12) for x in first[k : k + 3]] + rng.sample(range(300, 330), 8)
        monkeypatch.setattr(d, "ROUNDS", 10**9)
        whole = d.aligned_blocks(later, [20] * len(later), first, 50)
        monkeypatch.setattr(d, "ROUNDS", 0)
        assert d.aligned_blocks(later, [20] * len(later), first, 50) == whole


def test_every_shared_run_is_found(spark):
    # brute force: a line of 50 words or more that an earlier document holds must go
    rows = [(k, "\n".join(prose(1000 + (k * 7 + j * 3) % 11, 55) for j in range(4))) for k in range(30)]
    out = {r.doc_id: r.text for r in d.drop_passages(docs(spark, rows)).collect()}
    seen = set()
    for k, text in rows:
        assert out[k] == "\n".join(x for x in text.split("\n") if x not in seen)
        seen |= set(text.split("\n"))


def test_empty_table(spark):
    assert d.drop_passages(docs(spark, [])).count() == 0


def test_passages_that_begin_or_end_inside_a_line(spark):
    # one shared line of 20 words; the common run goes on inside the lines around it
    line, before, after = prose(70, 20), prose(71, 40), prose(72, 40)
    own = lambda k: prose(800 + k, 15)
    rows = [
        (1, f"{own(1)} {before}\n{line}\n{after} {own(2)}"),
        (2, f"{own(3)} {before}\n\n{line}\n{own(4)}"),  # 60 words, begins inside a line
        (3, f"{own(5)}\n{line}\n{after} {own(6)}"),  # 60 words, ends inside a line
        (4, f"{own(7)} {' '.join(before.split(" ")[-18:])}\n{line}\n{' '.join(after.split(" ")[:18])} {own(8)}"),  # 56 words
        (5, f"{own(9)} {' '.join(before.split(" ")[-12:])}\n{line}\nx {own(10)}"),  # 32 words: too short
        (6, f"{own(11)}\n{line}\n{own(12)}"),
    ]
    out = {r.doc_id: r.text for r in d.drop_passages(docs(spark, rows)).collect()}
    assert [line in out[k] for k in range(1, 7)] == [True, False, False, False, True, True]
    assert all(out[k].split("\n")[0] == rows[k - 1][1].split("\n")[0] for k in out)  # lines that are only partly common stay


def test_keys_of_many_texts_at_once():
    rng = random.Random(8)
    line = lambda k: " ".join(rng.choice(["", "é", "stone", "light"]) + str(rng.randrange(3)) for _ in range(k)).strip()
    pool = ["", "  ", "a  b", "　x ", *(line(k) for k in (1, 2, 4, 7, 12, 12))]
    texts = ["", "\n", *("\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(80))]
    keys, counts = d.passage_keys(texts, 9)
    found, want = [], []
    for text, lo, n in zip(texts, counts.cumsum() - counts, counts):
        lines = [x.strip() for x in text.split("\n")]
        words = [x.split(" ") if x else [] for x in lines]
        own = set()
        for i, mine in enumerate(words):
            for j in range(i + 1, len(lines) + 1):
                if mine and sum(map(len, words[i:j])) >= 9:
                    own.add(("run", *lines[i:j]))
                    break
            if 0 < len(mine) < 9:
                half = (9 - len(mine) + 1) // 2
                before, after = sum(words[:i], []), sum(words[i + 1 :], [])
                own |= {("before", lines[i], *before[-half:])} if len(before) >= half else set()
                own |= {("after", lines[i], *after[:half])} if len(after) >= half else set()
        found.append(set(keys[lo : lo + n].tolist()))
        want.append(own)
        assert n == len(found[-1])
    assert [len(x) for x in found] == [len(x) for x in want]
    assert [[len(a & b) for b in found] for a in found] == [[len(a & b) for b in want] for a in want]


def test_keys_cost_less_than_the_digests_of_the_same_texts():
    texts = ["\n".join(prose(10 * k + j, 12) for j in range(25)) for k in range(200)]
    d.passage_keys(texts[:2], 50)

    def seconds(work):
        start = time.process_time()
        work()
        return time.process_time() - start

    per_text = min(seconds(lambda: [(d.line_digest(x), d.word_digest(x)) for x in texts]) for _ in range(3))
    assert min(seconds(lambda: d.passage_keys(texts, 50)) for _ in range(3)) < per_text
