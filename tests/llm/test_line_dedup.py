from vitalflow.llm.line_dedup import dedup_lines


def test_later_windows_go_and_overlaps_merge(docs_of):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "b\nc\nd")]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(docs_of(rows)).collect()}
    assert got == {1: ("a\nb\nc\nd\ne", 5, 0), 2: ("x\ny", 6, 4), 3: ("a\nb", 2, 0), 4: ("", 3, 3)}


def test_repeats_within_a_text_and_blank_lines(docs_of):
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs_of([(1, "s\n" * 5 + "t"), (2, "\n\n\n\nq"), (3, "\n\n\n\nq")])).collect()}
    assert got[1] == "s\nt"            # lines 2 to 5 are covered by later occurrences of s s s
    assert got[2] == "\n\n\n\nq" and got[3] == "\n"  # blank windows never count, the one that ends in q does


def test_odd_rows(odd):
    got = dedup_lines(odd()).collect()
    assert len(got) == 11
    assert sorted(r["n_removed"] for r in got)[-1] > 2900 and sum(r["text"] is None for r in got) == 2
    assert dedup_lines(odd().limit(0)).count() == 0
