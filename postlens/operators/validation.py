"""Agreement of our classes with the data set's labels."""
from functools import reduce

from pyspark.sql import functions as F

from postlens.constants import CLASSES


def _cell(orig, predicted):
    return f"{orig}_as_{predicted}"


def _cells(confusion):
    """The nine counts of the 3x3 matrix in one row; other labels are left out, missing cells are 0."""
    def count(orig, predicted):
        hit = (F.col("orig") == orig) & (F.col("sentiment") == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).cast("double").alias(_cell(orig, predicted))
    return confusion.agg(*[count(o, p) for o in CLASSES for p in CLASSES])


def _total(columns):
    return reduce(lambda a, b: a + b, columns)


def confusion_matrix(confusion):
    """All nine (orig, sentiment) cells, zeros filled in."""
    rows = [F.struct(F.lit(o).alias("orig"), F.lit(p).alias("sentiment"), F.col(_cell(o, p)).cast("long").alias("count"))
            for o in CLASSES for p in CLASSES]
    return _cells(confusion).select(F.inline(F.array(*rows)))


def validation_metrics(confusion):
    """Accuracy, precision, recall and F1 per class, macro F1, labelled posts and label classes present."""
    cell = lambda o, p: F.col(_cell(o, p))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    of_label = {c: _total([cell(c, p) for p in CLASSES]) for c in CLASSES}
    of_prediction = {c: _total([cell(o, c) for o in CLASSES]) for c in CLASSES}
    total = _total(list(of_label.values()))

    metrics = {"accuracy": ratio(_total([cell(c, c) for c in CLASSES]), total)}
    for c in CLASSES:
        precision, recall = ratio(cell(c, c), of_prediction[c]), ratio(cell(c, c), of_label[c])
        metrics[f"precision_{c}"], metrics[f"recall_{c}"] = precision, recall
        metrics[f"f1_{c}"] = ratio(2 * precision * recall, precision + recall)
    metrics["macro_f1"] = _total([metrics[f"f1_{c}"] for c in CLASSES]) / len(CLASSES)
    metrics["n_labelled_posts"] = total
    metrics["classes_present_in_reference_labels"] = _total([(of_label[c] > 0).cast("double") for c in CLASSES])
    rows = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in metrics.items()]
    return _cells(confusion).select(F.inline(F.array(*rows)))
