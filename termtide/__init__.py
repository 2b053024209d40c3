"""Word, label and trend analytics over labelled reviews, as Spark DataFrame functions."""
