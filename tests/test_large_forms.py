"""Registered queries with all size bounds set so low that the forms for large data are taken."""

import pytest

from __spark_entry__ import oracle_sql, queries
from cadenza.operators import blocks, joins, ordering
from tools.compare import connect, difference, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
NAMES = [
    "p03_normalize_schema", "p12_similarity_features", "p14_output_rows", "p15_track_vector", "j01_join_audio",
    "j02_join_artists", "j03_known_unknown_seeds", "j05_best_of_all_pairs", "j06_gather_by_id", "j08_query_gram_join",
    "a14_rescale_per_query", "w01_group_totals", "w02_artist_run", "w03_rank_numbers", "w04_cumulative_hits",
    "t04_numbered_listing", "v09_nearest_inner_product", "v10_nearest_cosine", "q02_tfidf_weights", "q03_tfidf_search",
    "q05_fuzzy_search", "q07_vibe_search", "q10_search_service", "r02_hybrid_by_id", "r06_similar_by_name", "e08_report",
    "m01_profile_examples", "k01_collect",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_large_form(spark, con, monkeypatch, name):
    for module, bound, value in ((blocks, "MAX_QUERY_ROWS", 5), (blocks, "BLOCK_ROWS", 90), (joins, "BROADCAST_ROWS", 1),
                                 (joins, "ROWS_PER_SALT", 40), (ordering, "MAX_GROUP", 25)):
        monkeypatch.setattr(module, bound, value)
    got = spark_rows(queries()[name](spark, SF))
    assert difference(got, sql_rows(con, oracle_sql()[name])) is None
