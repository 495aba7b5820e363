"""Rules of the clustering on small points, and invariants on the features."""

import random

import pytest
from pyspark.sql import functions as F

from mailweave.operators import (
    FEATURES,
    assign,
    cluster_centers_raw,
    cluster_crosstab,
    cluster_profile,
    cluster_sizes,
    collect_stats,
    init_centroids,
    kmeans,
    person_features,
    standardize,
    update_centroids,
)


def points(spark, rows):
    named = [(f"e{i}", *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(named, "email string, x double, y double")


def test_constant_column_has_std_one(spark):
    df = points(spark, [(1.0, 5.0), (3.0, 5.0)])
    means, stds = collect_stats(df, ["x", "y"])
    assert (means, stds) == ([2.0, 5.0], [1.0, 1.0])
    scaled = standardize(df, ["x", "y"], means, stds).orderBy("email").collect()
    assert [(row.x, row.y) for row in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_tie_goes_to_the_lower_number(spark):
    df = points(spark, [(0.0, 0.0)])
    assert assign(df, ["x", "y"], [[2.0, 0.0], [1.0, 0.0], [0.0, 1.0]]).first().cluster == 1


def test_empty_cluster_keeps_its_centre(spark):
    df = points(spark, [(0.0, 0.0), (2.0, 2.0)])
    centres = update_centroids(df, ["x", "y"], [[0.0, 0.0], [99.0, 99.0]])
    assert centres == [[1.0, 1.0], [99.0, 99.0]]


def test_more_clusters_than_points(spark):
    with pytest.raises(ValueError, match="k=3"):
        kmeans(points(spark, [(0.0, 0.0), (2.0, 2.0)]), ["x", "y"], 3)


def test_two_clouds(spark):
    rng = random.Random(5)
    clouds = [(rng.gauss(c, 0.1), rng.gauss(c, 0.1)) for c in (0.0, 10.0) for _ in range(50)]
    df = points(spark, clouds)
    fit = kmeans(df, ["x", "y"], 2)
    members = {row.email: row.cluster for row in fit.assignments.collect()}
    assert len({members[f"e{i}"] for i in range(50)}) == 1
    assert members["e0"] != members["e99"]
    assert fit.history[-1] < 1e-6
    raw = {row.cluster: row.x for row in cluster_centers_raw(fit, ["x", "y"]).collect()}
    assert sorted(round(x) for x in raw.values()) == [0, 10]


def test_start_does_not_depend_on_partitions(spark):
    df = points(spark, [(float(i), 0.0) for i in range(200)])
    one = [row.email for row in init_centroids(df.coalesce(1), 4).collect()]
    many = [row.email for row in init_centroids(df.repartition(13), 4).collect()]
    assert one == many


@pytest.fixture(scope="module")
def features(spark, parsed):
    from mailweave.session import stage_path

    path = stage_path(spark, "features")
    person_features(parsed).write.parquet(path)
    return spark.read.parquet(path)


def test_inertia_never_rises(spark, features):
    means, stds = collect_stats(features, FEATURES)
    scaled = standardize(features, FEATURES, means, stds).cache()
    centres = [[row[c] for c in FEATURES] for row in init_centroids(scaled, 4).collect()]
    inertia = []
    for _ in range(6):
        distance = F.array_min(
            F.array(
                *[
                    sum((F.pow(F.col(c) - x, 2.0) for c, x in zip(FEATURES, centre)), F.lit(0.0))
                    for centre in centres
                ]
            )
        )
        inertia.append(scaled.agg(F.sum(distance)).first()[0])
        centres = update_centroids(scaled, FEATURES, centres)
    scaled.unpersist()
    assert all(later <= earlier + 1e-9 for earlier, later in zip(inertia, inertia[1:]))


def test_everyone_is_in_one_cluster(spark, features):
    fit3, fit4 = (kmeans(features, FEATURES, k) for k in (3, 4))
    people = features.count()
    for fit in (fit3, fit4):
        assert fit.assignments.select("email").distinct().count() == people
        sizes = {row.cluster: row.people for row in cluster_sizes(fit.assignments).collect()}
        assert sum(sizes.values()) == people
    crosstab = cluster_crosstab(fit3.assignments, fit4.assignments).collect()
    assert sum(row.people for row in crosstab) == people
    profile = cluster_profile(fit4.assignments, features, FEATURES, 4, {0: "first"}).collect()
    assert {row.cluster: row.label for row in profile} == {0: "first", 1: None, 2: None, 3: None}
    raw = {row.cluster: row.recvCount for row in cluster_centers_raw(fit4, FEATURES).collect()}
    for row in profile:
        assert raw[row.cluster] == pytest.approx(row.recvCount, abs=0.5)
