"""The flow operators over a trade schema: goods shipped between nations play the flights."""
