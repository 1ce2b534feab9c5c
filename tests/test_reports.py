"""Publications that replace their routes, die in between and are read meanwhile."""

import pytest

from farelens.sources import reports as R


def sales(spark, rows):
    return spark.createDataFrame(rows, "ORIGEN_DESTINO string, n int, VENTA double")


def minima(spark, rows):
    return spark.createDataFrame(rows, "peor double, ORIGEN_DESTINO string")


def seen(spark, root, table, version=None):
    return sorted(map(str, map(tuple, R.read_report(spark, root, table, version).collect())))


def test_a_second_publication_replaces_only_its_routes(spark, tmp_path):
    root = str(tmp_path)
    assert R.versions(spark, root) == []
    with pytest.raises(ValueError, match="nothing"):
        R.read_report(spark, root, "ventas")
    first = R.publish({"ventas": sales(spark, [("a-b", 1, 1.5), ("c d-é", 2, None), (None, 3, 0.5)]),
                       "minimos": minima(spark, [(0.25, "a-b"), (-1.0, "c d-é")])}, root)
    second = R.publish({"ventas": sales(spark, [("a-b", 9, 9.0), ("new", 4, 1.0)])}, root)
    assert (first, second) == (1, 2)
    assert seen(spark, root, "ventas") == sorted(map(str, [
        ("a-b", 9, 9.0), ("c d-é", 2, None), (None, 3, 0.5), ("new", 4, 1.0)]))
    assert seen(spark, root, "minimos") == sorted(map(str, [(0.25, "a-b"), (-1.0, "c d-é")]))
    assert seen(spark, root, "ventas", 1) == sorted(map(str, [
        ("a-b", 1, 1.5), ("c d-é", 2, None), (None, 3, 0.5)]))
    assert R.read_report(spark, root, "ventas").columns == ["ORIGEN_DESTINO", "n", "VENTA"]


def test_a_named_route_without_rows_becomes_empty(spark, tmp_path):
    root = str(tmp_path)
    R.publish({"ventas": sales(spark, [("a", 1, 1.0), ("b", 2, 2.0)])}, root)
    R.publish({"ventas": sales(spark, [("b", 3, 3.0)])}, root, routes=["a", "b"])
    assert seen(spark, root, "ventas") == [str(("b", 3, 3.0))]


def test_dying_between_tables_leaves_the_old_report_and_can_be_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    R.publish({"ventas": sales(spark, [("a", 1, 1.0)]), "minimos": minima(spark, [(1.0, "a")])}, root)
    new = {"ventas": sales(spark, [("a", 2, 2.0), ("b", 3, 3.0)]),
           "minimos": minima(spark, [(2.0, "a"), (3.0, "b")])}
    write, written = R.write_table, []

    def dies(frame, path, **how):
        if written:
            raise RuntimeError("executor lost")
        written.append(path)
        write(frame, path, **how)

    monkeypatch.setattr(R, "write_table", dies)
    with pytest.raises(RuntimeError, match="lost"):
        R.publish(new, root, name="again")
    assert R.versions(spark, root) == [1]
    assert seen(spark, root, "ventas") == [str(("a", 1, 1.0))]
    monkeypatch.setattr(R, "write_table", write)
    assert R.publish(new, root, name="again") == 2
    assert seen(spark, root, "ventas") == [str(("a", 2, 2.0)), str(("b", 3, 3.0))]
    assert seen(spark, root, "minimos") == [str((2.0, "a")), str((3.0, "b"))]


def test_of_two_publications_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    R.publish({"ventas": sales(spark, [("a", 1, 1.0)])}, root)
    R.publish({"ventas": sales(spark, [("a", 2, 2.0)])}, root)
    monkeypatch.setattr(R, "versions", lambda *_: [1])
    with pytest.raises(RuntimeError, match="somebody else"):
        R.publish({"ventas": sales(spark, [("a", 3, 3.0)])}, root)
    monkeypatch.undo()
    assert seen(spark, root, "ventas") == [str(("a", 2, 2.0))]
