"""Files that logs are dealt to for the streaming queries."""

from rollcall.plans import queries_ingest


def test_number_of_files_grows_with_the_logs(spark):
    assert queries_ingest._files(spark.range(5)) == 8
    assert queries_ingest._files(spark.range(10 * queries_ingest.FILE_LOGS)) == 10
