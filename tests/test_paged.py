"""Paged API source: retry rules and parallel paging."""

import json

import pytest

from conftest import write
from landfall.sources.paged import ApiError, Unauthorized, fetch
from landfall.fixtures import FaultyApi
from landfall.plans.api_job import read_pages


class Fake:
    def __init__(self, replies):
        self.replies = list(replies)
        self.calls = 0

    def __call__(self, params):
        self.calls += 1
        r = self.replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r


def test_fetch_status_rules():
    sleeps = []
    assert fetch(Fake([(200, "body")]), {"Page": 1}, sleep=sleeps.append) == (200, "body")
    assert fetch(Fake([(204, None)]), {"Page": 1}, sleep=sleeps.append) == (204, None)
    f = Fake([(500, None), (TimeoutError("t"),), (200, "ok")])
    f.replies[1] = TimeoutError("slow")
    assert fetch(f, {"Page": 1}, sleep=sleeps.append) == (200, "ok")
    assert sleeps == [1, 2]


def test_fetch_401_fails_at_once_and_no_sleep_after_last_attempt():
    sleeps = []
    f = Fake([(401, None), (200, "never")])
    with pytest.raises(Unauthorized):
        fetch(f, {"Page": 3}, sleep=sleeps.append)
    assert f.calls == 1 and sleeps == []
    with pytest.raises(ApiError, match="after 3 attempts"):
        fetch(Fake([(500, None)] * 3), {"Page": 1}, sleep=sleeps.append)
    assert sleeps == [1, 2]


def _pages(area, sizes):
    for p, n in enumerate(sizes, start=1):
        recs = [{"mendixUID": f"{p}-{i}"} for i in range(n)]
        write(f"{area}/pages/page={p}/part-0.json", json.dumps({"deviceResponseData": recs}) + "\n")


def test_partitions_read_interleaved_pages_until_first_empty(spark, area):
    _pages(area, [3, 1, 2, 2, 0, 5])           # page 5 empty: page 6 is never read
    df = read_pages(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": 3})
    got = sorted((r.page, r.position) for r in df.collect())
    assert got == [(1, 0), (1, 1), (1, 2), (2, 0), (3, 0), (3, 1), (4, 0), (4, 1)]


def test_empty_first_page_gives_no_rows(spark, area):
    _pages(area, [0])
    df = read_pages(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": 2})
    assert df.count() == 0


def test_outcomes_and_jvm_split(spark):
    from landfall.sources.paged import SCHEMA, outcome_of, page_records

    key = "deviceResponseData"
    for body, outcome in (('{"deviceResponseData": [{"a": 1}]}', "page"), ('{"deviceResponseData": [ ]}', "end"), ('{"other": [1]}', "end"),
                          ('{"deviceResponseData": null}', "end"), (None, "end"), ("<html>oops</html>", "failed"), ("[1]", "failed"),
                          ('{"deviceResponseData": [{"a": 1}, {"b"', "failed"),
                          ('{"source": "deviceResponseData", "deviceResponseData": [1]}', "page"),
                          ('{"x": {"deviceResponseData": []}, "deviceResponseData": [1]}', "page"),
                          ('{"x": {"deviceResponseData": [1]}, "deviceResponseData": []}', "end")):
        assert outcome_of(200, body, key)[0] == outcome, body
    df = spark.createDataFrame([(1, "page", '{"deviceResponseData": [{"a": 1}, {"b": {"c": 2}}]}', None, 2), (2, "end", None, None, None),
                                (3, "page", '{"deviceResponseData": [{"late": 1}]}', None, 1)], SCHEMA)
    got = sorted((r.page, r.position, r.record) for r in page_records(df).collect())
    assert got == [(1, 0, '{"a":1}'), (1, 1, '{"b":{"c":2}}')]


@pytest.mark.parametrize("partitions", [1, 3, 4])
def test_pages_that_carry_the_key_elsewhere_are_all_read(spark, area, partitions):
    """The key as a value, nested, escaped and twice: no page is taken for an empty one."""
    bodies = ['{"source":"deviceResponseData","deviceResponseData":[%s]}', '{"meta":{"deviceResponseData":[]},"deviceResponseData":[%s]}',
              '{"note":"\\"deviceResponseData\\": []","deviceResponseData":[%s]}', '{"deviceResponseData" :\t[ %s ]}']
    for p in range(1, 13):
        records = ",".join(json.dumps({"mendixUID": f"{p}-{i}"}) for i in range(5))
        write(f"{area}/pages/page={p}/part-0.json", bodies[p % 4] % records + "\n")
    df = read_pages(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": partitions})
    assert df.count() == 60


def test_failures_before_the_end_stop_the_job_and_later_ones_do_not(spark, area):
    from landfall.plans.api_job import FetchFailed, land_pages
    from landfall.sources.paged import stopped_by

    _pages(area, [2, 2, 2, 0])
    opts = {"transport": "files", "path": f"{area}/pages", "numPartitions": 2, "retries": 2, "source": FaultyApi}
    with pytest.raises(FetchFailed, match="page 3"):
        read_pages(spark, {**opts, "failPages": "3:2"})
    landed = land_pages(spark, {**opts, "failPages": "3:1"}, f"{area}/landed")
    assert stopped_by(landed) is None
    assert [(r.page, r.error) for r in landed.where("outcome = 'retry'").collect()] == [(3, "attempt 1: ApiError: HTTP 503 for page 3")]
    write(f"{area}/pages/page=6/part-0.json", "not json")
    write(f"{area}/pages/page=5/part-0.json", '{"deviceResponseData": [{"a": 1}]}')
    assert read_pages(spark, {**opts, "numPartitions": 3}).count() == 6      # page 6 is past the end


def test_206_is_retried_and_then_fails(spark, area):
    """Only 200 and 204 are answers, whatever the body of another status holds."""
    from landfall.plans.api_job import FetchFailed

    body = '{"deviceResponseData": [{"a": 1}]}'
    assert fetch(Fake([(206, body), (200, "ok")]), {"Page": 1}, sleep=lambda s: None) == (200, "ok")
    with pytest.raises(ApiError, match="HTTP 206"):
        fetch(Fake([(206, body)] * 3), {"Page": 1}, sleep=lambda s: None)
    _pages(area, [2, 2, 0])
    opts = {"transport": "files", "path": f"{area}/pages", "numPartitions": 2, "retries": 2, "failStatus": 206, "failBody": body, "source": FaultyApi}
    with pytest.raises(FetchFailed, match="page 2.*HTTP 206"):
        read_pages(spark, {**opts, "failPages": "2:2"})
    assert read_pages(spark, {**opts, "failPages": "2:1"}).count() == 4


DEEP = '{"mendixUID": "deep", "x": ' + "[" * 1100 + "]" * 1100 + "}"


def test_a_page_that_spark_cannot_parse_fails_the_job(spark, area):
    """The reader counts what it parsed; pages of which Spark reads another number are named."""
    from landfall.plans.api_job import RecordsLost, api_frame, land_pages
    from landfall.sources.paged import page_records, unread

    _pages(area, [2, 3, 1, 2])
    write(f"{area}/pages/page=2/part-0.json", '{"deviceResponseData": [{"mendixUID": "good"}, %s]}' % DEEP)
    opts = {"transport": "files", "path": f"{area}/pages", "numPartitions": 2}
    landed = land_pages(spark, opts, f"{area}/landed")
    assert sorted((r.page, r.records) for r in landed.where("outcome = 'page'").collect()) == [(1, 2), (2, 2), (3, 1), (4, 2)]
    assert [tuple(r) for r in unread(landed, page_records(landed)).collect()] == [(2, 2, 0)]
    with pytest.raises(RecordsLost, match="page 2: 2 records sent, 0 read$"):
        api_frame(spark, opts)
    write(f"{area}/pages/page=4/part-0.json", '{"deviceResponseData": [%s]}' % DEEP)
    with pytest.raises(RecordsLost, match=r"page 2: .* \(and 1 more pages\)"):
        api_frame(spark, opts)
    # a page past the end is not asked for by a sequential loop, and not missed
    write(f"{area}/pages/page=2/part-0.json", '{"deviceResponseData": []}')
    assert api_frame(spark, opts).count() == 2


@pytest.mark.parametrize("record", ["null", "5", '"text"', "[1, 2]"])
def test_a_record_that_is_no_object_fails_the_job(spark, area, record):
    """It would be a row of NULLs."""
    from landfall.plans.api_job import api_frame

    write(f"{area}/pages/page=1/part-0.json", '{"deviceResponseData": [{"mendixUID": "a"}, %s]}' % record)
    with pytest.raises(Exception, match="record 1 of page 1 cannot be parsed"):
        api_frame(spark, {"transport": "files", "path": f"{area}/pages"})


def test_odd_records_that_are_objects_are_read(spark, area):
    from landfall.plans.api_job import api_frame

    write(f"{area}/pages/page=1/part-0.json", '{"deviceResponseData": [{}, {"mendixUID": null}, {"mendixUID": {"a": 1}}, {"mendixUID": 7, "status": [1]}]}')
    got = sorted(((r.mendix_uid, r.status) for r in api_frame(spark, {"transport": "files", "path": f"{area}/pages"}).collect()), key=repr)
    assert got == sorted([(None, None), (None, None), ('{"a":1}', None), ("7", "[1]")], key=repr)


def test_a_body_nested_beyond_python_is_a_failed_page():
    from landfall.sources.paged import outcome_of

    outcome, error, records = outcome_of(200, '{"deviceResponseData": [' + "[" * 1_000_000 + "]" * 1_000_000 + "]}", "deviceResponseData")
    assert outcome == "failed" and "deeply" in error and records is None


def test_http_transport_builds_request_and_maps_errors(monkeypatch):
    import base64
    import io
    import urllib.error
    import urllib.parse

    from landfall.sources import paged

    seen = {}

    class Resp(io.BytesIO):
        status = 200

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

    def fake_urlopen(req, timeout):
        seen["url"], seen["auth"], seen["timeout"] = req.full_url, req.headers.get("Authorization"), timeout
        q = urllib.parse.parse_qs(urllib.parse.urlparse(req.full_url).query)
        if q["Page"] == ["9"]:
            raise urllib.error.HTTPError(req.full_url, 500, "boom", {}, None)
        return Resp(b'{"deviceResponseData": []}')

    monkeypatch.setattr(paged.urllib.request, "urlopen", fake_urlopen)
    get = paged.http_transport({"url": "https://api.invalid/x", "username": "u", "password": "p", "timeout": "120"})
    status, body = get({"limit": 1000, "Page": 2, "modifiedDate": "01/02/2024 00:00:00"})
    assert status == 200 and body == '{"deviceResponseData": []}'
    q = urllib.parse.parse_qs(urllib.parse.urlparse(seen["url"]).query)
    assert q == {"limit": ["1000"], "Page": ["2"], "modifiedDate": ["01/02/2024 00:00:00"]}
    assert seen["auth"] == "Basic " + base64.b64encode(b"u:p").decode() and seen["timeout"] == 120.0
    assert get({"limit": 1000, "Page": 9}) == (500, None)


def test_malformed_body_fails_instead_of_ending_paging(spark, area):
    from landfall.plans.api_job import FetchFailed

    for i, body in enumerate(("<html>oops</html>", '{"deviceResponseData": [{"a": 1}, {"b"')):
        write(f"{area}/{i}/page=1/part-0.json", body)
        with pytest.raises(FetchFailed, match="not a JSON object"):
            read_pages(spark, {"transport": "files", "path": f"{area}/{i}"})


def test_retried_attempts_are_reported_and_audited(spark, area):
    from landfall.plans.api_job import attempt_rows
    from landfall.plans.audit import AuditLog
    from landfall.sources.paged import SCHEMA, page_records

    errs = []
    f = Fake([(500, None), (503, None), (200, "ok")])
    assert fetch(f, {"Page": 4}, sleep=lambda s: None, on_error=errs.append) == (200, "ok")
    assert errs == ["attempt 1: ApiError: HTTP 500 for page 4", "attempt 2: ApiError: HTTP 503 for page 4"]
    errs.clear()
    with pytest.raises(ApiError):
        fetch(Fake([(500, None)] * 3), {"Page": 1}, sleep=lambda s: None, on_error=errs.append)
    assert len(errs) == 2                                   # the last failure raises instead

    raw = spark.createDataFrame([(1, "retry", None, "attempt 1: ApiError: HTTP 500 for page 1", None),
                                 (1, "page", '{"deviceResponseData": [{"a": 1}]}', None, 1), (2, "end", None, None, None)], SCHEMA)
    assert sorted((r.page, r.position) for r in page_records(raw).collect()) == [(1, 0)]
    log = AuditLog(spark, f"{area}/audit")
    log.append(attempt_rows(raw, "run-1", {"object_id": 3, "object_name": "device", "source_name": "mdx",
                                           "job_id": None, "job_name": None, "notebook_name": None}))
    r = log.read().first()
    assert (r.run_status, r.object_name, r.latest_update_dt) == ("FAILURE", "device", None)
    assert r.log_step == "REQUEST of page 1: attempt 1: ApiError: HTTP 500 for page 1"


def test_401_ends_the_partition_with_a_row_after_one_request(monkeypatch):
    from landfall.sources import paged

    asked = []

    def transport(options):
        def get(params):
            asked.append(params["Page"])
            return (401, None) if params["Page"] >= 3 else (200, '{"deviceResponseData": [1]}')
        return get

    monkeypatch.setitem(paged.TRANSPORTS, "test", transport)
    reader = paged.PagedApiReader(paged.Options({"transport": "test", "numPartitions": "2"}))
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[0], r[1]) for r in rows] == [(1, "page"), (3, "failed"), (2, "page"), (4, "failed")]
    assert asked == [1, 3, 2, 4] and "Unauthorized" in rows[1][3]


def test_batches_and_row_groups_are_bounded_by_the_pages_sizes(spark, area):
    """Spark gathers 10,000 rows into a batch and reads 4096 at once: of whole pages that is gigabytes."""
    import glob

    import pyarrow as pa
    import pyarrow.parquet as pq
    from landfall.plans.api_job import land_pages
    from landfall.sources import paged

    text = "x" * 300
    for p in range(1, 121):
        write(f"{area}/pages/page={p}/part-0.json", json.dumps({"deviceResponseData": [{"mendixUID": f"{p}-{i}", "status": text} for i in range(200)]}))
    opts = {"transport": "files", "path": f"{area}/pages", "numPartitions": "1"}
    reader = FaultyApi(opts).reader(None)
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert all(isinstance(b, pa.RecordBatch) and b.nbytes < 2 * paged.BATCH_BYTES for b in batches) and len(batches) > 5
    plain = paged.PagedApiReader(paged.Options(opts))
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == [r for p in plain.partitions() for r in plain.read(p)]
    land_pages(spark, opts, f"{area}/landed")
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(f"{area}/landed/*.parquet")]
    assert sum(m.num_rows for m in meta) == 121
    assert max(m.row_group(i).total_byte_size for m in meta for i in range(m.num_row_groups)) < 4_000_000
