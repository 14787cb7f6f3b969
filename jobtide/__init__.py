"""jobtide: DataFrame-native analytics over semi-structured postings and text corpora."""
