from checks import fixture as fx
from docwatch.plans import stages
from docwatch.schema import CLUSTERS, ITEMS

SF = "/root/testdata/sf0.001"


def test_whole_run(spark, as_of, tmp_path):
    entries = fx.feed_entries(spark, SF)
    run = stages.run_stages(
        spark.createDataFrame([], ITEMS), spark.createDataFrame([], CLUSTERS), as_of, fx.BOOK,
        entries=entries, settings=stages.Settings(hours=24 * 31, report_folder=str(tmp_path)),
    )
    stats = {r.stat: r.value for r in run.stats.collect()}
    assert stats["items before"] == 0 and stats["items"] == run.items.select("id").distinct().count() > 0
    assert stats["digest rows"] == run.digest.count() > 0
    sizes = {r.cluster_id: r.size for r in run.clusters.collect()}
    assert min(sizes.values()) >= 3
    members = run.members.collect()
    assert len({m.id for m in members}) == len(members) == sum(sizes.values())
    # every cluster the report shows has its summary
    shown = run.digest.join(run.clusters.select("cluster_id", "summary"), "cluster_id")
    assert shown.filter("summary is null").count() == 0
    assert "</html>" in "\n".join(r.value for r in spark.read.text(run.report).collect())
    # the next run over the same entries adds nothing
    again = stages.collect(run.items, entries, as_of)
    assert again.count() == run.items.count()


def test_vector_run(spark, as_of):
    rows = fx.plain_items(spark, SF)
    found = stages.cluster(
        rows, spark.createDataFrame([], CLUSTERS), as_of, fx.vectors(spark, SF), hours=24 * 31, distance=0.70,
        min_size=2,
    )
    sizes = [r.size for r in found.clusters.collect()]
    assert sizes and min(sizes) >= 2 and sum(sizes) == found.members.count()
