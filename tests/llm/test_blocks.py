"""License notices in long lines, and long lines that only hold the words."""

from cauce.llm import licenses


def test_words_scattered_over_a_long_line_are_no_notice(spark):
    rows, want = [], {}
    for template, label in licenses.TEMPLATES:
        words = template.split()
        want[len(rows)] = ""
        rows.append((len(rows), f" {'word ' * 40}".join(words)))
        for lead in (0, 5, 31, 32, 600):
            want[len(rows)] = label
            rows.append((len(rows), "word " * lead + template + " word" * 600))
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, label in want.items():
        if label:
            assert label in found[k].labels.split(",") and found[k].score == 1.0, rows[k]
        else:
            assert not found[k].labels and found[k].score == 0, rows[k]
