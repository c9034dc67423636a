import random
import re

import duckdb
from conftest import SF_DIR

from wattmill.llm import oracle
from wattmill.llm.unit_dedup import unit_dedup

LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    return [p for p in re.split(r"(?<=\n)|(?<=[.,;:!?] )", text) if p]


def unit(piece):
    return tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", piece.translate(LOWER)))


def brute_force(rows, least_words=25, least_unit=3):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        cut = pieces(text)
        runs, run = [], []
        for n, piece in enumerate(cut):
            u = unit(piece)
            if len(u) < least_unit:
                continue
            if u in seen:
                run.append(n)
            else:
                runs, run = [*runs, run], []
                seen.add(u)
        runs = [(r[0], r[-1]) for r in [*runs, run] if sum(len(unit(cut[n])) for n in r if len(unit(cut[n])) >= least_unit) >= least_words]
        gone = {n for a, b in runs for n in range(a, b + 1)}
        place = [sum(map(len, cut[:n])) for n in range(len(cut) + 1)]
        out[doc_id] = ("".join(p for n, p in enumerate(cut) if n not in gone), len(cut), len(gone), [(place[a], place[b + 1]) for a, b in runs])
    return out


def found(df):
    return {r.doc_id: (r.text, r.n_units, r.n_removed, [tuple(x) for x in r.removed]) for r in df.collect()}


def test_sample_equals_brute_force_and_sql(sample, texts):
    got = found(unit_dedup(sample))
    assert got == brute_force(texts.items())
    assert any(r for *_, r in got.values())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    sql = {d: (t, n, m, [tuple(map(int, s.split("-"))) for s in spans.split(",") if s]) for d, t, n, m, spans in con.execute(oracle.OP9).fetchall()}
    assert sql == got


PASSAGE = "The quick brown fox jumps over the lazy dog, and all the other animals of the wood look on. None of them says a word about it! Later in the evening they meet again; the fox is tired, the dog is not, and the moon is up."


def filler(seed, n=30):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_a_passage_inside_other_lines_goes(frame):
    rows = [(i, f"{filler(i)} so {PASSAGE} And {filler(100 + i)}.") for i in range(3)]
    got = found(unit_dedup(frame(rows)))
    assert got[0] == (rows[0][1], *got[0][1:]) and got[0][2] == 0
    for i in (1, 2):
        # the first words share their unit with what stands before, and stay
        assert "animals" not in got[i][0] and "moon" not in got[i][0]
        assert filler(i) in got[i][0] and filler(100 + i) in got[i][0]
        [(start, stop)] = got[i][3]
        assert rows[i][1][start:stop] in PASSAGE + " " and stop - start > 0.7 * len(PASSAGE)


def test_short_repeats_stay(frame):
    rows = [(i, f"{filler(i, 8)}.\nAll rights reserved by the owner.\n{filler(50 + i, 8)}, yes, no, of course, {filler(90 + i, 8)}") for i in range(4)]
    rows += [(9, ", ".join(["one two"] * 60)), (10, ", ".join(["one two"] * 60))]
    assert all(n == 0 for *_, n, _ in found(unit_dedup(frame(rows))).values())


def test_case_marks_and_spans_of_code_points(frame):
    line = "Älter \U0001f600 als vier Worte hier, und noch mehr davon"
    text = "\n".join(f"{line} {k}" for k in range(4))
    other = "é\U0001f600 vor\n" + text.replace("Worte", "WORTE").replace(",", " -- ") + " \nende der sache jetzt"
    got = found(unit_dedup(frame([(1, text), (2, other)])))
    assert got[1][0] == text
    # without the comma the units differ; with it they are equal in spite of case
    assert got[2][2] == 0
    other = "é\U0001f600 vor\n" + text.replace("Worte", "WORTE").replace("noch", "noch'") + "\nende der sache jetzt"
    got = found(unit_dedup(frame([(1, text), (2, other)])))
    assert got[2][0] == "é\U0001f600 vor\nende der sache jetzt"
    [(start, stop)] = got[2][3]
    assert other[:start] == "é\U0001f600 vor\n" and other[stop:] == "ende der sache jetzt"


def test_parameters(frame):
    rows = [(1, "a b c d e\nf g h\nx y"), (2, "p q r\na b c d e\nf g h\nz")]
    assert found(unit_dedup(frame(rows), least_words=8))[2][0] == "p q r\nz"
    assert found(unit_dedup(frame(rows), least_words=9))[2][0] == rows[1][1]
    assert found(unit_dedup(frame(rows), least_words=5, least_unit=4))[2][0] == "p q r\nf g h\nz"


def test_odd_rows(frame, odd):
    got = unit_dedup(frame(odd, "digest", "removed", "text_key", "gone", "n")).collect()
    assert len(got) == len(odd)
    # the two equal rows are one document; ties of doc_id go by the text's hash
    assert sorted((str(r.doc_id), r.text) for r in got if r.doc_id != 7 and r.doc_id and r.doc_id > 1) == sorted((str(d), t) for d, t in odd if d and 1 < d < 7)
    assert all(r.text is None and r.n_units == 0 for r in got if r.doc_id in (None, 1))


def test_empty_table(frame):
    assert unit_dedup(frame([])).collect() == []
