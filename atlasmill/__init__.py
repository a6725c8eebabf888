"""atlasmill: Spark-native entity resolution, history and confidence operators."""
