from sluice.llm.line_dedup import dedup_lines, without_repeated_lines

DDL = "doc_id long, text string, lang string, source string, n_chars long, kept string, row int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t), "x", 1)
                                  for i, t in rows], DDL)


def brute(rows):
    seen, out = {}, {}
    order = sorted({r for r in rows if r[1] is not None},
                   key=lambda r: (r[0] is None, r[0] or 0))
    spots = []
    for i, t in order:
        lines = t.split("\n")
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if any(w):
                spots.append((w, (i, t), p))
    gone = {}
    for w, d, p in spots:
        if w in seen:
            gone.setdefault(d, set()).update(range(p, p + 3))
        seen.setdefault(w, (d, p))
    for d in order:
        lines = d[1].split("\n")
        out[d] = "\n".join(x for n, x in enumerate(lines) if n not in gone.get(d, ()))
    return out


ROWS = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc"), (4, None), (5, ""), (6, "a\nb"),
        (7, "q\nq\nq\nq\nq"), (8, "\n\n\n\n\n"), (8, "\n\n\n\n\n"), (9, "b\nc\nd\na\nb\nc"),
        (10, "m\nn\no"), (10, "m\nn\no"), (None, "m\nn\no\np"), (11, "é\nü\n\n"), (12, "z\né\nü\n\n")]


def test_agrees_with_brute_force(spark):
    expected = brute(ROWS)
    got = [(r["row"]["doc_id"], r["row"]["text"], r["kept"], r["n_lines"], r["n_removed"])
           for r in dedup_lines(spark, _docs(spark, ROWS)).collect()]
    assert len(got) == len(ROWS)
    for i, text, kept, n, removed in got:
        if text is None:
            assert (kept, n, removed) == (None, 0, 0)
        else:
            assert kept == expected[(i, text)], (i, text)
            assert n == text.count("\n") + 1
            assert removed == n - (kept.count("\n") + 1 if removed < n else 0)


def test_stage_keeps_columns_and_drops_only_what_is_all_repeats(spark):
    docs = _docs(spark, ROWS)
    out = without_repeated_lines(spark, docs)
    assert out.columns == docs.columns
    rows = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert (3, "") not in rows and not any(i == 3 for i, _ in rows)
    assert rows[(2, "x\ny")]["n_chars"] == 3 and rows[(2, "x\ny")]["kept"] == "x"
    assert (4, None) in rows and (5, "") in rows and (6, "a\nb") in rows


def test_no_documents(spark):
    assert dedup_lines(spark, _docs(spark, ROWS).limit(0)).count() == 0


def test_a_long_text(spark):
    long = "\n".join(str(i % 700) for i in range(50_000))
    row = dedup_lines(spark, _docs(spark, [(1, long)])).first()
    assert (row["n_lines"], row["kept"].count("\n") + 1) == (50_000, 702 - 2)
