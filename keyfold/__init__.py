"""keyfold: folds a stream of JSON messages into a keyed document store on Spark."""
