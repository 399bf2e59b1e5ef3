"""A corpus query and its SQL on the same folder, compared value by value without order."""

import compare

from tidepanel.llm import queries


def differences(spark, name, folder):
    df = queries.QUERIES[name](spark, folder)
    columns, got = compare._rows(df.columns, [tuple(r) for r in df.collect()])
    rel = compare.connect(folder).execute(queries.SQL[name])
    wanted, want = compare._rows([d[0] for d in rel.description], rel.fetchall())
    assert columns == wanted and len(got) == len(want) > 0
    return [(a, b) for a, b in zip(got, want) if a != b][:5]
