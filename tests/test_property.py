"""Random change sequences: batch replay and normalised micro-batches equal sequential replay."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from .helpers import batch_result, cust, item, normalised_result, order, python_replay

ops = st.sampled_from(["INSERT", "INSERT", "DELETE"])
change = st.one_of(
    st.builds(lambda op, k, s: cust(op, k, seg=s), ops, st.integers(1, 2),
              st.sampled_from(["AUTOMOBILE", "BUILDING"])),
    st.builds(lambda op, k, c, d: order(op, k, c, date=d), ops, st.integers(10, 11),
              st.integers(1, 2), st.sampled_from(["1995-01-01", "1995-03-13"])),
    st.builds(lambda op, o, ln, p: item(op, o, ln, price=p), ops, st.integers(10, 11),
              st.integers(1, 2), st.sampled_from(["10.00", "20.00"])),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(change, min_size=1, max_size=14), cut=st.integers(0, 14))
def test_random_changes(spark, lines, cut):
    import tempfile
    expected = python_replay(lines)
    assert batch_result(spark, lines) == expected
    cuts = [c for c in [cut] if 0 < c < len(lines)]
    assert normalised_result(spark, lines, cuts, tempfile.mkdtemp(prefix="deltaq-prop-"), 1) \
        == expected
