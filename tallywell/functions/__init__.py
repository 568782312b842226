"""tallywell.functions"""
