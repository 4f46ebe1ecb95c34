"""Entity operators: no row repeated for distinct counts, and what is null."""

from docloom.operators import entities as ent

KIND = "protocol_id long, section_id long, classification string, category_domain string, entity_text string, entity_type string, confidence double"
ROWS = [(1, 1, "a", "x", "Aspirin", "DRUG", 0.5), (1, 1, "a", "x", "aspirin ", "DRUG", 1.0), (1, 1, "a", "y", "b", None, None), (None, 2, "a", None, "b", None, 0.25), (2, 1, "c", "x", None, "DRUG", 1.0), (2, None, "c", "x", "b", None, 1.0)]


def test_no_row_is_repeated_for_distinct_counts(spark):
    rows = spark.createDataFrame(ROWS, KIND)
    for made in (ent.catalog, ent.protocol_summary, ent.cooccurrence):
        assert "Expand" not in made(rows)._jdf.queryExecution().optimizedPlan().toString()


def test_null_types_and_keys(spark):
    rows = spark.createDataFrame(ROWS, KIND)
    found = {(r.entity_norm, r.entity_type): (r.occurrence_count, r.protocol_count, r.section_count, r.protocol_list, r.variant_count, r.rank_in_type) for r in ent.catalog(rows).collect()}
    assert found == {("aspirin", "DRUG"): (2, 1, 1, [1], 2, 1), ("b", None): (3, 2, 2, [1, 2], 1, 1), (None, "DRUG"): (1, 1, 1, [2], 0, 2)}
    both = sorted((r.entity1, r.entity2, r.cooccurrence_count, r.protocol_count, r.section_count, r.cooccurring_in) for r in ent.cooccurrence(rows).collect())
    assert both == [("aspirin", "aspirin", 1, 1, 1, "a"), ("aspirin", "b", 2, 1, 1, "a")]
    assert ent.pairs(rows).count() == 3
    assert {r.protocol_id: (r.total_entities, r.unique_entities, r.unique_entity_types, r.unique_domains) for r in ent.protocol_summary(rows).collect()} == {1: (3, 2, 1, 2), 2: (2, 1, 1, 1), None: (1, 1, 0, 0)}
