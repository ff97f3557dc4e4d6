from pathlib import Path

from staylytics.session import release_scratch, scratch_path, settle


def test_release_deletes_what_was_settled(spark):
    df = settle(spark.range(5))
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
    other = scratch_path(spark, "unused")
    assert df.count() == 5 and folder.exists()
    release_scratch(spark)
    assert not folder.exists() and not Path(other).exists()
