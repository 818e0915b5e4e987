from pagewright.operators import attachments

SCHEMA = "doc_id bigint, parent_id bigint, idx int, filename string, file_hash string"


def test_a_chain_of_forty_ends_where_it_repeats(spark):
    nodes = [(i, i - 1 or None, 1, f"f{i}.pdf", f"h{i}") for i in range(1, 41)] + [(41, 40, 1, "again.pdf", "h3"), (42, 41, 1, "below.pdf", "x"), (90, 91, 1, "ring", "r"), (91, 90, 1, "ring", "s"), (95, 94, 1, "lost", "t")]
    got = {r["doc_id"]: (r["depth"], r["cycle"]) for r in attachments.tree(spark.createDataFrame(nodes, SCHEMA)).collect()}
    assert got == {**{i: (i - 1, False) for i in range(1, 41)}, 41: (40, True)}
