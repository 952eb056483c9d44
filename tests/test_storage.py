"""The life cycle of stored tables."""

import os

from genopile.storage import Tables, materialize, release


def there(table):
    return os.path.isdir(table.stored_at.removeprefix("file:"))


def test_tables_are_released_together_or_one_by_one(spark):
    outside = materialize(spark.range(3), "outside")
    with Tables(spark) as made:
        a = materialize(spark.range(4), "a")
        with Tables(spark) as inner:
            b = materialize(spark.range(5), "b")
        c = materialize(spark.range(6), "c")
    after = materialize(spark.range(7), "after")
    assert len(made.paths) == 2 and len(inner.paths) == 1
    made.release()
    assert [there(t) for t in (outside, a, b, c, after)] == [True, False, True, False, True]
    inner.release()
    release(outside, after)
    assert not any(there(t) for t in (outside, b, after))
    made.release()
