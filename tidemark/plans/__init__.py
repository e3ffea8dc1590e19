"""The whole job, in data order."""
