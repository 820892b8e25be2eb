"""Whole flows: the ad hoc questions, the index walk, the year job."""
