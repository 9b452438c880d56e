import hashlib
import random
import re

from depthframe.llm import secrets
from tests.llm.fixtures import docs, prose

R = random.Random(4)
TOKEN = lambda n, a="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789": "".join(R.choice(a) for _ in range(n))
CASES = [
    "Password = 'abc123' token:short api_key=\"" + "Q" * 30 + '" APIKEY : zzzzzz',
    "AKIA" + "A1" * 8 + " AKIAshort xAKIA" + "B" * 17,
    "f" * 24 + "g" + "0123456789abcdef" * 3 + " " + "a" * 23,
    "ſecret = abcdefgh toKen=abcdefgh",  # only ASCII letters fold
    "é" * 50 + " secret=abcdef é " + "ab12" * 9,
    None,
    "",
]


def brute(text):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans_equal_the_patterns(spark):
    rows = list(enumerate(CASES)) + [(0, CASES[0]), (None, CASES[1])]
    found = secrets.scan_secrets(docs(spark, rows, extra=True)).collect()
    got = sorted((str(r.doc_id), [tuple(b) for b in r.base]) for r in found)
    assert got == sorted((str(i), brute(t)) for i, t in rows)


def test_query_counts_each_kind_and_hashes_all_base_spans(spark, tmp_path):
    hexes = " ".join(f"{i:032x}" for i in range(40))
    rows = list(enumerate([*CASES, hexes, f"{hexes} AKIA{'B2' * 9} token=abcdef secret=abcdefg", "1234567890" * 3, "AKIA" + "C" * 16 + " AKIA" + "D" * 16]))
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.op7_secrets(spark, str(tmp_path)).collect()}
    for i, text in rows:
        base = brute(text)
        written = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert got[i] == (*(sum(k == kind for _, k, _ in base) for kind in range(3)), hashlib.sha256(written.encode()).hexdigest())


def test_battery_accepts_random_and_rejects_text():
    runs = [TOKEN(40) for _ in range(300)]
    _, p = secrets.battery(runs)
    assert (p > 0.01).mean() > 0.95
    _, p = secrets.battery(["thereisnothingeitherthatcouldbedoneaboutthestatementsofthecommittee", "abcd1234" * 8, "a1" * 30])
    assert (p < 0.01).all()
    names = [secrets.ALPHABETS[k] for k in secrets.battery(["0" * 20, "ab12" * 5, "ABCDEFG234567ABCDEFG", "aA" * 10, "a-B_3" * 5, "a=="])[0]]
    assert [len(a) for a in names] == [10, 16, 32, 52, 64, 16]


def test_random_runs_are_added_and_text_is_not(spark):
    wanted = {i: TOKEN(48) for i in range(60)}
    rows = [(i, f"{prose(i, 30)} {'thatandtheriverstonelightunder' + 'abc' * (i % 5)} {wanted.get(i, 'aaaa1111' * 5)} end") for i in range(120)]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan_secrets(docs(spark, rows)).collect()}
    text = dict(rows)
    hits = {i: [text[i][s:e] for s, k, e in spans if k == 3] for i, spans in found.items()}
    assert sum(hits[i] == [wanted[i]] for i in wanted) > 50
    assert not any(hits[i] for i in range(60, 120))


def test_headings_and_single_symbols_do_not_stop_the_table(spark):
    odd = ["A" + "=" * 24, "=" * 30, "a" + "-" * 30, "-" * 40, "a" * 50, "0" * 20, "AB" + "=" * 40 + "C"]
    rows = list(enumerate(odd)) + [(50 + i, prose(i, 40)) for i in range(10)]
    found = secrets.scan_secrets(docs(spark, rows)).collect()
    assert len(found) == len(rows) and not any(s.kind == 3 for r in found for s in r.spans)
    assert (secrets.battery(["A", "AB", "=" * 30, "a" * 30])[1] > 0).all()
    assert secrets.battery(["A", "AB"])[1].tolist() == [1, 1]


def test_keys_of_letters_alone_are_found(spark):
    """Also where a hot source is full of them: repeats and keys do not move the cuts."""
    lower, both = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = [TOKEN(40, lower) for _ in range(50)] + [TOKEN(40, both) for _ in range(50)] + [TOKEN(64) for _ in range(50)]
    same = TOKEN(40, lower)
    text = ["thereisnothingeitherthatcouldbedone", "TheRiverStoneLightUnderWinterMorningHarbour", "river_stone_light_under_winter_2024_01"]
    words = "there is nothing either that could be done about the statements of committee members during long winter sessions where everyone waited quietly"
    rows = [(i, f"{prose(i, 60)} {words} {k} end") for i, k in enumerate(keys)]
    rows += [(1000 + i, f"{same} {words}") for i in range(400)] + [(2000 + i, f"{text[i % 3]} {words} {prose(i, 20)}") for i in range(60)]
    hits = {r.doc_id: sum(s.kind == 3 for s in r.spans) for r in secrets.scan_secrets(docs(spark, rows)).collect()}
    assert sum(hits[i] == 1 for i in range(50)) >= 45
    assert sum(hits[i] == 1 for i in range(50, 150)) >= 95
    assert all(hits[1000 + i] == 1 for i in range(400))
    assert sum(hits[2000 + i] for i in range(60)) == 0


def test_composed_runs_do_not_depend_on_the_partitions(spark):
    rows = [(i, f"{prose(i, 50)} {TOKEN(30)}") for i in range(80)]
    one = sorted(secrets.scan_secrets(docs(spark, rows).coalesce(1)).collect())
    assert one == sorted(secrets.scan_secrets(docs(spark, rows).repartition(7)).collect())


def test_empty_table(spark):
    assert secrets.scan_secrets(docs(spark, [])).count() == 0
