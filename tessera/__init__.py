"""tessera: labelled-sheet normalisation and text classification as Spark DataFrame jobs.

Every public operator takes DataFrames and returns a DataFrame. Nothing is
collected to the driver except fitted model parameters whose size is fixed by
the model (number of classes x feature width), never by the data.
"""

from tessera.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
