"""tallywell.streaming"""
