"""skygrid.sources"""
