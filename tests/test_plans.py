"""Physical-plan properties the operators rely on at scale."""

import contextlib
import io
import re

from tabletrust.plans import REGISTRY

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        REGISTRY[name].build(spark, SF).explain(mode="formatted")
    return buf.getvalue()


def tree(p: str) -> str:
    return p.split("\n\n")[0]


def test_fold_is_partially_aggregated_before_the_shuffle(spark):
    p = plan(spark, "last_failed")
    assert "partial_max_by" in p
    t = tree(p)
    assert t.index("Exchange") < t.rindex("Aggregate")  # an aggregate below (map side of) the exchange


def test_top_k_has_partial_group_limit(spark):
    t = tree(plan(spark, "retention_all"))
    assert t.count("WindowGroupLimit") == 2
    assert t.index("WindowGroupLimit") < t.index("Exchange") < t.rindex("WindowGroupLimit")


def test_domain_check_pushes_down_and_prunes(spark):
    p = plan(spark, "range_len_domain")
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(In(o_orderstatus, [F,O]))]" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in p


def test_primary_key_check_combines_map_side(spark):
    p = plan(spark, "pk_violations")
    assert "partial_count" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p


def test_compare_is_one_full_outer_join(spark):
    p = plan(spark, "near_cells")
    assert len(re.findall(r"Join FullOuter|FullOuter", tree(p))) >= 1
    assert tree(p).count("Join") == 1


def test_lookup_broadcasts_bounded_codes(spark):
    assert "BroadcastHashJoin" in tree(plan(spark, "lookup"))


def test_numbering_never_windows_the_whole_input(spark):
    p = plan(spark, "failed_first")
    # The row_number over data rows is partitioned by the range slice; the
    # only unpartitioned window runs over the per-slice counts.
    assert re.search(r"row_number\(\) windowspecdefinition\(__pid#\d+,.*\], \[__pid#\d+\]", p)
    assert re.search(r"sum\(__n#\d+L?\) windowspecdefinition", p)
