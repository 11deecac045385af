"""chatlake: a Spark-native engine for conversation-transcript warehouses."""
