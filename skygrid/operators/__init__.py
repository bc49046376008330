"""skygrid.operators"""
