"""The registered upsert covers every workflow; the rows to match come from the T14 document SQL, which has no filter on ids."""

from tally.plans.timing_oracle import DOCUMENT
from tally.plans.timing_queries import t14_document_upsert
from tests.conftest import SF_SMALL
from tests.oracle_compare import fingerprint


def test_upsert_covers_all_workflows(spark, duck_small):
    df = t14_document_upsert(spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck_small.execute(DOCUMENT + """
        select '2.34.0' as version, usecase, 'the new one' as title, workers, cast(tasks as bigint) as tasks, completed_at,
               cast(case when workers > 1 then tasks else 0 end as bigint) as mapped
        from doc""")
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert {int(r[1]) % 6 for r in want} == set(range(6))
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    assert fingerprint(df.columns, got)[0] == fingerprint(columns, want)[0]
